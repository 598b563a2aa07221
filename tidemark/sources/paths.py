"""Opening files inside tasks, where Spark's own readers cannot help."""

from __future__ import annotations

import re

# Spellings of cluster storage that Arrow knows under another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def portable(uri: str) -> str:
    """The name Arrow's file systems use for a Spark path; plain paths for local files."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")  # where the workspace mounts it
    if scheme in ("wasb", "wasbs"):
        rest = re.sub(r"\.blob\.core\.windows\.net", ".dfs.core.windows.net", rest, count=1)
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def file_system(uri: str):
    """Arrow's file system for a Spark path, and the name of the file in it."""
    from pyarrow import fs

    name = portable(uri)
    return (fs.LocalFileSystem(), name) if "://" not in name else fs.FileSystem.from_uri(name)


def open_file(uri: str):
    system, name = file_system(uri)
    return system.open_input_file(name)
