from . import evaluate, predict, prep, report, scoring, syntax, telemetry

__all__ = ["evaluate", "predict", "prep", "report", "scoring", "syntax", "telemetry"]
