"""Relational building blocks of the models."""

from revlens.operators.dedup import keep_first, latest_name
from revlens.operators.joins import join_dimension
from revlens.operators.merge import merge_upsert
from revlens.operators.ranking import rank_descending, top_k
from revlens.operators.sampling import sample_keys, sample_rows

__all__ = [
    "join_dimension",
    "keep_first",
    "latest_name",
    "merge_upsert",
    "rank_descending",
    "sample_keys",
    "sample_rows",
    "top_k",
]
