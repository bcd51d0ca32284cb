"""termweave: Spark-native building, checking and scoring of term-constrained
bilingual corpora.  Every operator takes and returns DataFrames; see README.md."""

from termweave.operators import (  # noqa: F401
    answering, corpus, evaluation, generation, matching, mining, ordering, parallel, prompting,
)
from termweave.session import checkpoint_dir, get_spark  # noqa: F401

__all__ = ["answering", "corpus", "evaluation", "generation", "matching", "mining", "ordering",
           "parallel", "prompting", "checkpoint_dir", "get_spark"]
