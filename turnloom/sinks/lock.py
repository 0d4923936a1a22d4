"""A lock that lets one run write at a time, in the store's own file system.

The lock is a file that only one of several can create, through Hadoop's file systems, so drivers on
different machines exclude each other. Its holder renews it; one that is stale, or
whose process is gone from this machine, is taken over with a higher fence number. A
holder asks before it commits whether the lock is still its own, so one that was taken over can't write.
"""

from __future__ import annotations

import json
import os
import socket
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: A lock that wasn't renewed for so long is taken over, whoever holds it; renewals are this far apart.
STALE_SECONDS, RENEW_SECONDS = 30 * 60, 60


class Locked(RuntimeError):
    pass


class Files:
    """Small text files of a Hadoop file system."""

    def __init__(self, spark: SparkSession, near: str):
        self.jvm = spark._jvm
        self.fs = self.path(near).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def read(self, path: str) -> str | None:
        """None if it isn't there or can't be read."""
        try:
            stream = self.fs.open(self.path(path))
            try:
                return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
        except Py4JJavaError:
            return None

    def write(self, path: str, text: str, new: bool) -> bool:
        """False if it had to be new and is there."""
        try:
            out = self.fs.create(self.path(path), not new)
        except Py4JJavaError as error:
            if new and ("AlreadyExists" in str(error.java_exception) or self.fs.exists(self.path(path))):
                return False
            raise
        out.writeBytes(text)
        out.close()
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), False)


def _record(text: str | None) -> dict:
    try:
        found = json.loads(text or "")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def _alive(pid: int) -> bool:
    try:
        os.kill(pid, 0)
    except (ProcessLookupError, OverflowError):
        return False
    except PermissionError:
        return True
    return True


class Lease:
    """A held lock: its fence number, and whether it is still one's own."""

    def __init__(self, files: Files, path: str, now: Callable[[], float]):
        self.files, self.file, self.now = files, path, now
        self.holder, self.fence = uuid.uuid4().hex, 0

    def free(self) -> bool:
        """Whether the lock that is there may be taken over."""
        held, renewed = _record(self.files.read(self.file)), _record(self.files.read(f"{self.file}.renewed"))
        try:
            at = float(held["at"])
            if renewed.get("holder") == held.get("holder", ""):
                at = max(at, float(renewed["at"]))
            here = held.get("host", socket.gethostname()) == socket.gethostname()
            return self.now() - at >= STALE_SECONDS or here and not _alive(int(held["pid"]))
        except (KeyError, TypeError, ValueError):
            return True

    def take(self) -> None:
        record = {"holder": self.holder, "host": socket.gethostname(), "pid": os.getpid(), "at": self.now()}
        for last in (False, True):
            if self.files.write(self.file, json.dumps(record), new=True):
                # under the lock, so no two holders have one number
                self.fence = int(_record(self.files.read(f"{self.file}.fence")).get("fence", 0)) + 1
                self.files.write(f"{self.file}.fence", json.dumps({"fence": self.fence}), new=False)
                return
            if last or not self.free():
                raise Locked(f"another run holds {self.file}")
            self.files.delete(self.file)

    def mine(self) -> bool:
        return _record(self.files.read(self.file)).get("holder") == self.holder

    def check(self) -> None:
        """Raises if another run has taken the lock over."""
        if not self.mine():
            raise Locked(f"another run has taken over {self.file}")

    def renew(self) -> None:
        if self.mine():
            self.files.write(f"{self.file}.renewed", json.dumps({"holder": self.holder, "at": self.now()}), new=False)

    def release(self) -> None:
        """Only one's own lock is released; the fence number stays."""
        if self.mine():
            self.files.delete(self.file)
            self.files.delete(f"{self.file}.renewed")


@contextmanager
def import_lock(path: str, now: Callable[[], float] = time.time, renew_seconds: float = RENEW_SECONDS, spark: SparkSession | None = None) -> Iterator[Lease]:
    """Holds the lock file and renews it; a holder that is gone or stale loses it."""
    lease = Lease(Files(spark or SparkSession.active(), path), path, now)
    lease.take()
    over = threading.Event()

    def beat() -> None:
        while not over.wait(renew_seconds):
            lease.renew()

    threading.Thread(target=beat, daemon=True).start()
    try:
        yield lease
    finally:
        over.set()
        lease.release()
