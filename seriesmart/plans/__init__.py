from .run import DatasetPaths, LoadResult, load_all, load_dataset, read_inputs
from .legacy import LegacySpec, load_legacy_dataset, part_keys, yearly_files
from .star import StarDim, StarSpec, load_bulk_dataset, load_star_dataset, read_star_facts
from .specs import DATASETS, DatasetSpec, parse_ddl, select_datasets
from .status import status_report
from .wide import wide_table

__all__ = ["DatasetPaths", "LoadResult", "load_all", "load_dataset", "read_inputs", "DATASETS",
           "DatasetSpec", "parse_ddl", "StarDim", "StarSpec", "load_bulk_dataset", "load_star_dataset",
           "read_star_facts", "LegacySpec", "load_legacy_dataset", "part_keys",
           "yearly_files", "select_datasets", "status_report", "wide_table"]
