"""What of a run is done, so that a run that broke off goes on where it was."""

import json
import threading

from ..sinks.switch import Store

_COMPLETE = "_SUCCESS"


class Ledger:
    """The finished steps of the run of one batch time, in a small file beside the Bronze batches."""

    def __init__(self, spark, layers, batch_ts, resume=False):
        self._path = f"{layers.bronze.rstrip('/')}/_runs/{batch_ts:%Y%m%d_%H%M%S}.json"
        self._store = Store(spark, self._path)
        self._lock = threading.Lock()
        self._done = {}
        if resume and self._store.exists(self._path):
            self._done = json.loads(self._store.read(self._path))

    def kept(self, step):
        """What was noted for a step: rows in and out, and the path; None if it must run.

        A step whose files have gone since must run again.
        """
        noted = self._done.get(step)
        if noted is None or not self._store.exists(f"{noted['path']}/{_COMPLETE}"):
            return None
        return noted

    def note(self, step, rows_in, rows_out, path):
        with self._lock:
            self._done[step] = {"rows_in": rows_in, "rows_out": rows_out, "path": path}
            self._store.make_folder(self._path.rpartition("/")[0])
            self._store.write(self._path, json.dumps(self._done))

    def forget(self, step):
        """The step runs again, so that what follows from it must too."""
        with self._lock:
            self._done.pop(step, None)
