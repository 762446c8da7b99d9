"""Stored layouts of the given tables: written once per application to the shared folder, then read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from tidewater.session import shared_folder
from tidewater.sources.tables import Tables

_BUILT: dict[tuple[str, str, str], str] = {}


def layout(t: Tables, name: str, build: Callable[[str], object]) -> str:
    """The folder that ``build(folder)`` has filled for these tables.

    The set-up runs when the layout is first asked for; a set-up that fails leaves nothing that is read, the next one
    starts in a new folder. Later queries of the application only read.
    """
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _BUILT:
        path = f"{shared_folder(t.spark)}/layouts/{name}-{uuid.uuid4().hex}"
        build(path)
        _BUILT[key] = path
    return _BUILT[key]
