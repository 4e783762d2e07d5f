"""Binary files in the shared folder, written and read by tasks as streams.

A task writes under a name of its own and renames the complete file into
place, so a lost or repeated task leaves either nothing or the whole file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@contextmanager
def writing(path: str) -> Iterator:
    """A binary output stream; the file appears at ``path`` when the block ends well."""
    store, target = _store(path)
    own = f"{target}.{uuid.uuid4().hex}.tmp"
    store.create_dir(target.rpartition("/")[0], recursive=True)
    with store.open_output_stream(own, compression=None) as out:
        yield out
    store.move(own, target)


@contextmanager
def reading(path: str) -> Iterator:
    """A binary input stream."""
    store, target = _store(path)
    with store.open_input_stream(target, compression=None) as source:
        yield source
