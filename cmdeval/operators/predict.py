"""Batch prediction with a user-supplied model callable."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..constants import IM_END, IM_START
from ..session import ensure_package_on_workers

Predictor = Callable[[Sequence[str]], Sequence[str]]


def run(df: DataFrame, make_predictor: Callable[[], Predictor], prompt_col: str = "prompt",
        batch_size: int = 1) -> DataFrame:
    """Adds ``raw_prediction``, ``latency`` and ``is_error``.

    ``make_predictor`` is called once per partition (load a model there).
    Each call is timed; its time is shared by the prompts of that call. A
    failing call gives ``("", 0.0)`` and ``is_error`` for its prompts. The
    answer is stripped.
    """
    schema = T.StructType(df.schema.fields + [
        T.StructField("raw_prediction", T.StringType()),
        T.StructField("latency", T.DoubleType()),
        T.StructField("is_error", T.BooleanType())])
    size = max(1, int(batch_size))
    ensure_package_on_workers(df.sparkSession)

    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = make_predictor()
        for pdf in batches:
            prompts = pdf[prompt_col].fillna("").astype(str).tolist()
            raw: list[str] = []
            lat: list[float] = []
            err: list[bool] = []
            for i in range(0, len(prompts), size):
                chunk = prompts[i:i + size]
                t0 = time.perf_counter()
                try:
                    outs = list(predictor(chunk))
                    if len(outs) != len(chunk):
                        raise ValueError("predictor returned a different number of answers")
                    each = (time.perf_counter() - t0) / len(chunk)
                    raw += ["" if o is None else str(o).strip() for o in outs]
                    lat += [each] * len(chunk)
                    err += [False] * len(chunk)
                except Exception:
                    raw += [""] * len(chunk)
                    lat += [0.0] * len(chunk)
                    err += [True] * len(chunk)
            yield pdf.assign(raw_prediction=raw, latency=lat, is_error=err)

    return df.mapInPandas(per_partition, schema)


def echo_user_predictor() -> Predictor:
    """A stand-in model: answers with the first line of the prompt's user block."""
    head = IM_START + "user\n"

    def predict(prompts: Sequence[str]) -> list[str]:
        out = []
        for p in prompts:
            start = p.find(head)
            body = p[start + len(head):] if start >= 0 else p
            out.append(body.split(IM_END, 1)[0].split("\n", 1)[0])
        return out

    return predict
