from pulse.sinks.files import csv_description, publish_single_file, write_dataset

__all__ = ["csv_description", "publish_single_file", "write_dataset"]
