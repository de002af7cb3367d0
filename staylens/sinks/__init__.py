"""Writers: the served report CSV and the mart tables."""

from staylens.sinks.files import report_file_name, write_marts, write_report_csv, write_table  # noqa: F401
from staylens.sinks.versioned import CommitConflict, VersionedTable, read_table  # noqa: F401
