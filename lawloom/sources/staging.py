"""Files that appear together: staged by tasks, moved to their places by one commit.

Tasks write below <root>/_staged/<job>/.  A commit first writes the list of its moves there,
under a name that only a complete list ever has, and then moves the files; from that list on
the commit can only be carried on.  `recover` does so for commits that were cut off, and what
a job without a list left behind is never seen at the files' places.

`root` is a URI or path that pyarrow can open on the driver and on all executors.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterable

from pyarrow import fs

STAGED = "_staged"
_LIST = "moves.json"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root and its path there; Hadoop writes file:/x for file:///x."""
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")
    store, top = fs.FileSystem.from_uri(root)
    return store, top.rstrip("/")


def checked(name: str) -> str:
    """A relative name that stays below its root."""
    parts = name.split("/")
    if name.startswith("/") or any(p in ("", ".", "..") for p in parts) or parts[0] == STAGED:
        raise ValueError(f"not a name below the root: {name!r}")
    return name


def new_job() -> str:
    return uuid.uuid4().hex


def _gone(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type == fs.FileType.NotFound


def _carried_out(store: fs.FileSystem, top: str, job: str) -> None:
    folder = f"{top}/{STAGED}/{job}"
    with store.open_input_stream(f"{folder}/{_LIST}") as f:
        todo = json.loads(f.read())
    for place in sorted({posixpath.dirname(b) for _, b in todo["moves"]}):
        store.create_dir(f"{top}/{place}", recursive=True)
    for a, b in todo["moves"]:
        if not _gone(store, f"{folder}/{a}"):  # moved before the commit was cut off
            if not _gone(store, f"{top}/{b}"):
                store.delete_file(f"{top}/{b}")
            store.move(f"{folder}/{a}", f"{top}/{b}")
    for old in todo["drop"]:
        if not _gone(store, f"{top}/{old}"):
            store.delete_file(f"{top}/{old}")
    store.delete_dir(folder)


def commit(root: str, job: str, moves: Iterable[tuple[str, str]], drop: Iterable[str] = ()) -> None:
    """Move staged files (name below the job's folder, name below root) in order, then delete
    the files `drop`.  Two files for one place are an error, and nothing is moved."""
    store, top = opened(root)
    moves = [(a, checked(b)) for a, b in moves]
    if len({b for _, b in moves}) < len(moves):
        raise ValueError("two files for one place")
    folder = f"{top}/{STAGED}/{job}"
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/{_LIST}.part") as f:
        f.write(json.dumps({"moves": moves, "drop": [checked(d) for d in drop]}).encode())
    store.move(f"{folder}/{_LIST}.part", f"{folder}/{_LIST}")
    _carried_out(store, top, job)


def abort(root: str, job: str) -> None:
    """Delete what a job has staged, unless its commit has begun."""
    store, top = opened(root)
    folder = f"{top}/{STAGED}/{job}"
    if not _gone(store, folder) and _gone(store, f"{folder}/{_LIST}"):
        store.delete_dir(folder)


def recover(root: str) -> int:
    """Carry on the commits that were cut off; returns how many."""
    store, top = opened(root)
    n = 0
    for info in store.get_file_info(fs.FileSelector(f"{top}/{STAGED}", allow_not_found=True)):
        if info.type == fs.FileType.Directory and not _gone(store, f"{info.path}/{_LIST}"):
            _carried_out(store, top, info.base_name)
            n += 1
    return n
