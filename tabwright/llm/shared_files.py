"""Files in the folder all executors share, through the file system its address names."""

from __future__ import annotations

import pyarrow.fs as pafs


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def put(folder: str, name: str, content: bytes, attempt: int = 0) -> None:
    """Write a file whole: readers see the old one or the new one, also when several attempts write it."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/_{name}.{attempt}") as out:
        out.write(content)
    system.move(f"{path}/_{name}.{attempt}", f"{path}/{name}")


def get(folder: str, name: str) -> bytes:
    system, path = opened(folder)
    with system.open_input_stream(f"{path}/{name}") as source:
        return source.read()


def get_if_there(folder: str, name: str) -> bytes | None:
    system, path = opened(folder)
    if system.get_file_info(f"{path}/{name}").type != pafs.FileType.File:
        return None
    return get(folder, name)
