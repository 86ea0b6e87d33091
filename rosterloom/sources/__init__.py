"""Reading folders of loosely structured files as text."""

from rosterloom.sources.folder import (
    Source,
    SourceError,
    list_files,
    profile_source,
    read_folder,
)
from rosterloom.sources.publish import (
    PublishOptions,
    publish,
    read_published,
    write_csv,
    write_parquet,
)
from rosterloom.sources.staged import read_staged

__all__ = [
    "PublishOptions",
    "Source",
    "SourceError",
    "list_files",
    "profile_source",
    "publish",
    "read_folder",
    "read_published",
    "read_staged",
    "write_csv",
    "write_parquet",
]
