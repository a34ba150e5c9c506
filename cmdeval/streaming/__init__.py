from .increments import IncrementTable, WindowTables, running_totals
from .streams import (LOG_TS_FORMAT, finish_running, latest, loss_windows, run_availablenow, running_evaluation,
                      running_evaluation_table, tail_log, telemetry_windows, window_tables)
from .log_source import json_records, tail_lines, train_log_records

__all__ = ["IncrementTable", "WindowTables", "running_evaluation_table", "running_totals", "window_tables", "json_records", "tail_lines", "train_log_records", "LOG_TS_FORMAT", "loss_windows", "finish_running", "latest", "run_availablenow", "running_evaluation", "tail_log",
           "telemetry_windows"]
