"""Binary files in the shared folder, written and read by tasks.

A file is written under a name of its own attempt and moved to its final name when it is
complete, so that a repeated task replaces its file as a whole and readers see whole files only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@contextmanager
def new_file(path: str) -> Iterator:
    """A stream to a file that appears as `path` when the block ends without an error."""
    system, place = located(path)
    draft = f"{place}.{uuid.uuid4().hex}.draft"
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, place)


@contextmanager
def opened(path: str) -> Iterator:
    """A file for reading at any place, with `size()`, `seek()` and `read()`."""
    system, place = located(path)
    with system.open_input_file(place) as source:
        yield source
