from pulse.plans.datasets import DATASETS, Dataset, build_dataset, source_tables
from pulse.plans.params import Params, Words
from pulse.plans.job import run

__all__ = ["DATASETS", "Dataset", "Params", "Words", "build_dataset", "run", "source_tables"]
