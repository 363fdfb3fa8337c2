"""Sources and sinks: driver parquet tables, the respondents view, the survey CSV, writers."""

from .respondents import raw_survey_shape, respondents, respondents_cte
from .sinks import read_catalogue, read_table_dir, write_labelled, write_table, write_tables
from .survey_csv import CSV_OPTIONS, read_survey_csv, stage_survey_csv, survey_schema
from .tables import DRIVER_TABLES, read_table, table_path

__all__ = [
    "CSV_OPTIONS", "DRIVER_TABLES", "raw_survey_shape", "read_catalogue", "read_survey_csv", "read_table",
    "read_table_dir", "respondents", "respondents_cte", "stage_survey_csv", "survey_schema",
    "table_path", "write_labelled", "write_table", "write_tables",
]
