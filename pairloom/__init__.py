"""Byte-pair encoding as Spark jobs over tables of text."""

import sys

from pyspark import cloudpickle

# Functions run in Python workers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from pairloom.plans.tokenizer import Tokenizer  # noqa: E402
from pairloom.plans.train import resume_training, train_bpe  # noqa: E402

__all__ = ["Tokenizer", "resume_training", "train_bpe"]
