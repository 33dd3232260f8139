"""Answers that are kept one by one as they arrive, so that a lost task costs one call."""

from __future__ import annotations

import hashlib
import json
import uuid


class Journal:
    """A folder of finished answers, one file for each question.

    Tasks write to it themselves: the folder is shared and its scheme one that pyarrow opens. A file
    is written beside its place and moved there, so a question has a whole answer or none; a task
    that is run again finds the answers of its first attempt.
    """

    def __init__(self, folder: str, scope: str = "") -> None:
        self.folder, self.scope = folder.rstrip("/"), scope

    def key(self, chunk_id: str, prompt: str) -> str:
        return hashlib.sha256(json.dumps([self.scope, chunk_id, prompt]).encode()).hexdigest()

    def _at(self, key: str):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.folder)
        return system, f"{root}/{key[:2]}", f"{root}/{key[:2]}/{key}.json"

    def get(self, key: str) -> dict | None:
        from pyarrow import fs

        system, _, path = self._at(key)
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def put(self, key: str, answer: dict) -> None:
        system, folder, path = self._at(key)
        system.create_dir(folder, recursive=True)
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(beside) as f:
            f.write(json.dumps(answer).encode())
        system.move(beside, path)
