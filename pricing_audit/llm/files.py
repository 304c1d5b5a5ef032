"""Files in the shared folder, written and read by tasks through the folder's own file system."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or absolute path."""
    return fs.FileSystem.from_uri(folder)


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A name no other attempt of the same task uses; only names that a finished task reported
    count, so files of lost or repeated attempts are never read."""
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_write(name: str):
    folder, _, base = name.rpartition("/")
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{base}", compression=None)


def open_read(name: str):
    folder, _, base = name.rpartition("/")
    system, path = open_folder(folder)
    return system.open_input_file(f"{path}/{base}")
