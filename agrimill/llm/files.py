"""Binary files in the shared folder, opened inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and local name of a path or URI (local, or any store pyarrow knows)."""
    return fs.FileSystem.from_uri(path)


def new_name(folder: str, part: int, ending: str) -> str:
    """A name no other attempt of the task uses; which attempt counts is settled by the table that lists the files."""
    return f"{folder}/part-{part:05d}-{uuid.uuid4().hex}{ending}"


def make_folder(path: str) -> None:
    store, name = opened(path)
    store.create_dir(name, recursive=True)
