from ebbline.streaming.prediction_metrics import read_totals, run_available, stream_prediction_metrics

__all__ = ["read_totals", "run_available", "stream_prediction_metrics"]
