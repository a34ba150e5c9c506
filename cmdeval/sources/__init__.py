from .schemas import GPU_SAMPLE_SCHEMA, PAIR_SCHEMA, RESPONSE_SCHEMA, RUN_LOG_SCHEMA, SUITE_SCHEMA
from .readers import (read_gpu_samples, read_pairs, read_responses, read_run_log, read_suite,
                      write_corpus)
from . import fixtures

__all__ = [
    "GPU_SAMPLE_SCHEMA", "PAIR_SCHEMA", "RESPONSE_SCHEMA", "RUN_LOG_SCHEMA", "SUITE_SCHEMA",
    "read_gpu_samples", "read_pairs", "read_responses", "read_run_log", "read_suite",
    "write_corpus", "fixtures",
]
