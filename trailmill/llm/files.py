"""Binary files in the shared folder, by URI, from inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_output(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_input(uri: str):
    """Random access for reading."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def listed(uri: str, ending: str) -> list[tuple[str, int]]:
    """(uri, bytes) of the files in a folder, by name."""
    system, path = fs.FileSystem.from_uri(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=False))
    prefix = uri.rstrip("/")
    return sorted(
        (f"{prefix}/{x.base_name}", x.size) for x in found if x.is_file and x.base_name.endswith(ending)
    )


def exists(uri: str) -> bool:
    system, path = fs.FileSystem.from_uri(uri)
    return system.get_file_info(path).type != fs.FileType.NotFound


def delete(uri: str) -> None:
    system, path = fs.FileSystem.from_uri(uri)
    system.delete_file(path)


def fresh_name(prefix: str, ending: str) -> str:
    """A name no other attempt of the task has; only files named in a committed manifest count."""
    return f"{prefix}-{uuid.uuid4().hex}{ending}"
