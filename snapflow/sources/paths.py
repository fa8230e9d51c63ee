"""File systems for the Python readers, and how their code reaches the workers."""

from __future__ import annotations

import sys
from urllib.parse import quote

import pyarrow.fs
from pyspark import cloudpickle


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow file system and path for a plain path or URI, names with spaces and other odd characters included."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        host, slash, tail = rest.partition("/")
        fs, _ = pyarrow.fs.FileSystem.from_uri(f"{scheme}://{host}{slash}{quote(tail)}")
        local = f"{host}/{tail}" if scheme in ("s3", "s3a", "gs", "gcs") else f"/{tail}"
        return fs, local
    return pyarrow.fs.LocalFileSystem(), path


def ship(module: str) -> None:
    """Send a module's functions to the workers by value: they need not have the package installed."""
    for name in (module, __name__):
        cloudpickle.register_pickle_by_value(sys.modules[name])
