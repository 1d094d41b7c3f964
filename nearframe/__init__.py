"""nearframe: exact k-nearest-neighbour classification on Spark DataFrames.

Public surface (see README for the operator inventory):

    sources   read_points_csv, read_points_text, read_points_arff
    shape     split_label, assemble, with_row_id, profile_points
    distance  euclidean, squared_euclidean
    join      pairwise_distances, pairs_within, knn_join, attach_labels
    index     build_index, load_index
    top-k     top_k_per_group, merge_top_k, update_neighbours
    vote      vote_counts, majority_vote
    evaluate  confusion_matrix, accuracy, evaluation_summary, write_evaluated
    ml        operators.ml: NearestNeighbours, NearestNeighboursModel
    end2end   knn_classify
    sinks     write_predictions
"""

from .functions.distance import euclidean, squared_euclidean
from .operators.evaluate import accuracy, confusion_matrix, evaluation_summary, write_evaluated
from .operators.neighbors import (
    attach_labels,
    knn_join,
    lists_to_neighbours,
    merge_top_k,
    neighbours_to_lists,
    pairwise_distances,
    top_k_per_group,
    update_neighbours,
)
from .operators.within import pairs_within
from .operators.vote import majority_vote, vote_counts
from .plans.classify import knn_classify
from .plans.index import build_index, load_index
from .sources import (
    read_points_arff,
    read_points_csv,
    read_points_text,
    read_predictions,
    write_points_arff,
    write_points_text,
    write_predictions,
)

__all__ = [
    "euclidean",
    "squared_euclidean",
    "pairwise_distances",
    "pairs_within",
    "knn_join",
    "build_index",
    "load_index",
    "update_neighbours",
    "attach_labels",
    "top_k_per_group",
    "merge_top_k",
    "neighbours_to_lists",
    "lists_to_neighbours",
    "vote_counts",
    "majority_vote",
    "confusion_matrix",
    "accuracy",
    "evaluation_summary",
    "write_evaluated",
    "knn_classify",
    "read_points_csv",
    "read_points_text",
    "read_points_arff",
    "write_predictions",
    "read_predictions",
    "write_points_text",
    "write_points_arff",
]
