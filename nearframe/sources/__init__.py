"""Point sources and prediction sinks."""

from .points import read_points_arff, read_points_csv, read_points_text
from .sinks import read_predictions, write_points_arff, write_points_text, write_predictions

__all__ = [
    "read_points_csv",
    "read_points_text",
    "read_points_arff",
    "write_predictions",
    "read_predictions",
    "write_points_text",
    "write_points_arff",
]
