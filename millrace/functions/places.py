"""Files in any store that the Arrow file systems know, and drafts that become files at a job's commit."""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

from pyarrow import fs


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI and the place in it; a local place is taken as it is written."""
    if local := re.fullmatch(r"(?:file:/*)?(/.*|[^:]*)", path):
        return fs.LocalFileSystem(), "/" + local[1].lstrip("/")
    if secured := re.fullmatch(r"s3[an]:(.*)", path):
        path = f"s3:{secured[1]}"
    return fs.FileSystem.from_uri(quote(path, safe=":/?=&*[]"))


def files_under(path: str, suffix: str = "") -> list[fs.FileInfo]:
    """The visible files of a folder and of those in it, or the one file the path names, by name."""
    store, root = place_of(path)
    if store.get_file_info(root).type == fs.FileType.File:
        return [store.get_file_info(root)]
    listed = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    hidden = re.compile(r"/[._]")
    shown = (i for i in listed if i.type == fs.FileType.File and i.path.endswith(suffix))
    return sorted((i for i in shown if not hidden.search(i.path[len(root) :])), key=lambda i: i.path)


def matching_files(pattern: str) -> Iterator[tuple[str, fs.FileInfo]]:
    """The visible files that a path or glob names, each with its URI, by name.

    A star stands for any part of a name. Folders above the first one with a glob sign are not listed.
    """
    store, place = place_of(pattern)
    scheme = re.match(r"[A-Za-z0-9+.-]+:(//[^/]*)?(?=/)", pattern)
    head = "file://" if isinstance(store, fs.LocalFileSystem) else scheme[0] if scheme else ""
    if not re.search(r"[*?\[]", place):
        info = store.get_file_info(place)
        if info.type == fs.FileType.File:
            yield f"{head}{place}", info
        return
    base = re.split(r"[^/]*[*?\[]", place, maxsplit=1)[0]
    whole = re.compile("/".join(fnmatch.translate(part)[:-2].replace(".*", "[^/]*") for part in place.split("/")) + r"\Z")
    below = store.get_file_info(fs.FileSelector(base, recursive="/" in place[len(base) :], allow_not_found=True))
    for info in sorted(below, key=lambda i: i.path):
        if info.type == fs.FileType.File and not info.base_name.startswith((".", "_")) and whole.match(info.path):
            yield f"{head}{info.path}", info


class Drafts:
    """Files that tasks write aside and that the commit moves to their names.

    Every write has a folder of its own for drafts, hidden under the target. The commit moves what the tasks that
    count have reported, then removes the folder, so attempts that failed or lost leave nothing behind.
    """

    def __init__(self, path: str) -> None:
        self.path, self.run = path, uuid.uuid4().hex

    def _root(self) -> tuple[fs.FileSystem, str]:
        store, root = place_of(self.path)
        return store, root.rstrip("/")

    def create(self) -> tuple[fs.FileSystem, str]:
        """A new draft's store and place."""
        store, root = self._root()
        folder = f"{root}/_drafts-{self.run}"
        store.create_dir(folder, recursive=True)
        return store, f"{folder}/{uuid.uuid4().hex}"

    def publish(self, moves: list[tuple[str, str]], replaced: str | None = None, within: Iterable[str] = ("",)) -> None:
        """Moves drafts to their names below the target, one that is there already giving way.

        Then removes the files that were in the folders ``within`` (by default the target) and whose name below the
        target the pattern ``replaced`` matches. Only these folders are listed.
        """
        store, root = self._root()
        store.create_dir(root, recursive=True)
        earlier = {i.path for folder in within for i in files_under(f"{self.path}/{folder}".rstrip("/"))} if replaced else set()
        kept = set()
        for folder in sorted({name.rpartition("/")[0] for _, name in moves}):
            store.create_dir(f"{root}/{folder}", recursive=True)
        for draft, name in moves:
            # Run again after a commit that broke off: what it has moved already is in place.
            if store.get_file_info(draft).type == fs.FileType.File:
                store.move(draft, f"{root}/{name}")
            kept.add(f"{root}/{name}")
        for path in sorted(earlier - kept):
            if re.match(replaced, path[len(root) + 1 :]):
                store.delete_file(path)
        self.clear()

    def clear(self) -> None:
        store, root = self._root()
        folder = f"{root}/_drafts-{self.run}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)
