"""Replace folders of files by finished ones, so that a failure at any point loses no table.

New files are written beside the table first. Once they are complete, a small marker names them, and
only then the old files go and the new ones take their place. Whoever next opens the table finds the
marker of a switch that was broken off and ends it. On a file system with renames a folder is
moved at once; an object store copies its files on its own side.
"""

import json
import uuid

_COMPLETE = "_SUCCESS"


class MissingTable(RuntimeError):
    pass


class Store:
    """Files and folders of one file system, by full path."""

    def __init__(self, spark, path):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path):
        return self._fs.exists(self._path(path))

    def names(self, path):
        """Names in a folder; none if it does not exist."""
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(path))]

    def written(self, path):
        """Names in a folder, without hidden ones, and when each was finished."""
        if not self.exists(path):
            return {}
        found = {}
        for status in self._fs.listStatus(self._path(path)):
            name = status.getPath().getName()
            mark = f"{path}/{name}/{_COMPLETE}"
            if status.isDirectory() and self.exists(mark):
                status = self._fs.getFileStatus(self._path(mark))
            if name[0] not in "_.":
                found[name] = status.getModificationTime()
        return found

    def delete(self, path):
        self._fs.delete(self._path(path), True)

    def rename(self, source, target):
        """Whether `source` is now `target`."""
        return self._fs.rename(self._path(source), self._path(target))

    def make_folder(self, path):
        self._fs.mkdirs(self._path(path))

    def write(self, path, text):
        """A small file that is there as a whole or not at all."""
        part = f"{path}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(path):
            self.delete(path)
        if not self.rename(part, path):
            raise OSError(f"cannot write {path}")

    def read(self, path):
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _beside(path, kind):
    """A folder next to `path` that readers of its parent skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}/{name}"


def staging_folder(path):
    """A new folder for what is to replace `path`; its last part is the name of the table."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staged/{uuid.uuid4().hex}/{name}"


def switch(spark, staged, path, parts=None):
    """Put the finished folder `staged` in the place of `path`.

    `parts` names the sub-folders to replace; the others of `path` stay. One switch of a table runs at a
    time. Readers that began before it may fail, as their files go, but never get a mixture from
    `open_table`.
    """
    store = Store(spark, path)
    if not store.exists(f"{staged}/{_COMPLETE}"):
        raise MissingTable(f"{staged} is not complete")
    moves = [
        {"from": source, "to": target, "names": store.names(source)}
        for source, target in _moves(staged, path, parts)
    ]
    marker = _beside(path, "switching")
    store.make_folder(marker.rpartition("/")[0])
    store.write(marker, json.dumps({"staged": staged, "moves": moves}))
    settle(spark, path)


def _moves(staged, path, parts):
    if parts is None:
        return [(staged, path)]
    return [(f"{staged}/{part}", f"{path}/{part}") for part in parts]


def settle(spark, path):
    """End a switch of `path` that was broken off, if there is one."""
    store = Store(spark, path)
    marker = _beside(path, "switching")
    if not store.exists(marker):
        return
    begun = json.loads(store.read(marker))
    for move in begun["moves"]:
        _move(store, move["from"], move["to"], move["names"])
    store.delete(begun["staged"].rpartition("/")[0])
    store.delete(marker)


def _move(store, source, target, names):
    """Files `names` from one folder to another, in place of all others there. May run again."""
    if not store.exists(source):
        return  # moved before
    # Only names of data files differ from one write to the next.
    kept = {name for name in store.names(target) if name in names and name[0] not in "_."}
    if not kept:
        store.delete(target)
        store.make_folder(target.rpartition("/")[0])
        if not store.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")
        return
    # A store that moves file by file was broken off.
    for name in set(store.names(target)) - kept:
        store.delete(f"{target}/{name}")
    for name in sorted(store.names(source), key=lambda name: name == _COMPLETE):
        store.delete(f"{target}/{name}")
        if not store.rename(f"{source}/{name}", f"{target}/{name}"):
            raise OSError(f"cannot move {source}/{name} to {target}")
    store.delete(source)


def require_table(spark, path):
    """An error unless a whole table lies at `path`; ends a switch that was broken off."""
    settle(spark, path)
    if not Store(spark, path).exists(f"{path}/{_COMPLETE}"):
        raise MissingTable(f"no complete table at {path}")
    return path
