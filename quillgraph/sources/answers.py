"""Answers of outside services, kept by content address in shared storage while tasks run.

A task looks an answer up before it asks and stores it at once, so a task that runs again after
its executor was lost asks nothing twice. Marks in the same folder tell all tasks to stop.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyarrow import fs


class ServiceError(Exception):
    """A call that failed with a status (0 for none) and, if the service said so, seconds to wait."""

    def __init__(self, status: int, message: str = "", retry_after: float | None = None):
        super().__init__(message or f"HTTP {status}")
        self.status, self.retry_after = status, retry_after


class Answers:
    """JSON answers below ``folder``, a URI that every task can open."""

    def __init__(self, folder: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)

    def _path(self, key: str) -> str:
        name = hashlib.sha256(key.encode()).hexdigest()
        return f"{self.root}/{name[:2]}/{name}.json"

    def get(self, key: str) -> dict | None:
        try:
            with self.store.open_input_stream(self._path(key)) as found:
                return json.loads(found.read())
        except FileNotFoundError:
            return None

    def put(self, key: str, answer: dict) -> None:
        path = self._path(key)
        self.store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        beside = f"{path}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(beside) as out:
            out.write(json.dumps(answer).encode())
        self.store.move(beside, path)

    def mark(self, name: str) -> None:
        self.store.create_dir(self.root, recursive=True)
        with self.store.open_output_stream(f"{self.root}/{name}.mark") as out:
            out.write(b"1")

    def marked(self, name: str) -> bool:
        return self.store.get_file_info(f"{self.root}/{name}.mark").type != fs.FileType.NotFound


def retried(call: Callable[[], object], attempts: int, delay: float, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call``, again after a status of 429, 5xx or none, up to ``attempts`` times in all.

    It waits as long as the service asked for, else ``delay`` seconds that double each time.
    """
    for attempt in range(attempts):
        try:
            return call()
        except Exception as problem:
            status, wait = getattr(problem, "status", 0), getattr(problem, "retry_after", None)
            if attempt == attempts - 1 or not (status in (0, 429) or status >= 500):
                raise
            sleep(wait if wait is not None and wait >= 0 else delay * 2**attempt)
    raise ValueError("attempts must be positive")
