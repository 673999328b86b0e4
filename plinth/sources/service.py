"""Client of a batch OCR service over HTTP, and its answers as the archives that sources.files reads.

One file is one task: a request for an upload place, the upload, polling until the state is done, the archive. The
calls run where the PDF bytes are (mapInArrow), so many files are converted at once; nothing passes the driver.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame


class ServiceError(RuntimeError):
    pass


@dataclass(frozen=True)
class Service:
    base_url: str
    api_key: str
    poll_seconds: float = 3
    most_seconds: float = 600
    timeout: float = 120
    model_version: str = "vlm"
    language: str = "ch"
    is_ocr: bool = True
    enable_formula: bool = True
    enable_table: bool = True

    def __post_init__(self) -> None:
        if not self.api_key:
            raise ServiceError("no API key")

    def call(self, url: str, body: bytes | None = None, method: str = "GET", headers: dict[str, str] | None = None) -> tuple[int, bytes]:
        request = urllib.request.Request(url, body, headers or {}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()

    def ask(self, path: str, payload: dict | None = None) -> dict:
        """The data of a JSON answer; anything but status 200 and code 0 is an error."""
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
        body = None if payload is None else json.dumps(payload).encode()
        status, raw = self.call(f"{self.base_url.rstrip('/')}{path}", body, "GET" if body is None else "POST", headers)
        try:
            answer = json.loads(raw)
        except ValueError:
            raise ServiceError(f"status {status}, no JSON: {raw[:200]!r}") from None
        if status != 200 or answer.get("code") != 0:
            raise ServiceError(f"status {status}: {raw[:200]!r}")
        return answer.get("data") or {}

    def create(self, name: str, data_id: str) -> tuple[str, str]:
        """Batch id and upload URL of a new task."""
        options = {"model_version": self.model_version, "language": self.language, "enable_formula": self.enable_formula, "enable_table": self.enable_table}
        data = self.ask("/api/v4/file-urls/batch", {"files": [{"name": name, "data_id": data_id, "is_ocr": self.is_ocr}], **options})
        if not data.get("file_urls"):
            raise ServiceError("no upload URL")
        return data["batch_id"], data["file_urls"][0]

    def upload(self, url: str, content: bytes) -> None:
        status, raw = self.call(url, content, "PUT")
        if status not in (200, 201):
            raise ServiceError(f"upload: status {status}: {raw[:200]!r}")

    def result(self, batch: str, name: str | None = None) -> dict:
        """The finished result of a batch (the named file's, else the first), polled for most_seconds at most."""
        end = time.monotonic() + self.most_seconds
        while time.monotonic() <= end:
            found = self.ask(f"/api/v4/extract-results/batch/{batch}").get("extract_result") or []
            found = [found] if isinstance(found, dict) else found
            if not found:
                raise ServiceError("no result")
            row = next((r for r in found if r.get("file_name") == name), found[0])
            if row.get("state") == "done":
                return row
            if row.get("state") == "failed":
                raise ServiceError(row.get("err_msg") or "failed")
            time.sleep(self.poll_seconds)
        raise ServiceError(f"not done after {self.most_seconds} s: {batch}")

    def archive(self, name: str, content: bytes) -> bytes:
        batch, url = self.create(name, data_id(name.rsplit(".", 1)[0]))
        self.upload(url, content)
        status, raw = self.call(self.result(batch, name)["full_zip_url"])
        if status != 200:
            raise ServiceError(f"download: status {status}")
        return raw


def data_id(value: str) -> str:
    """As functions.text.safe_data_id."""
    clean = re.sub(r"[^A-Za-z0-9_.\-]", "_", value).strip("._-") or "paper"
    return f"{clean[:110]}-{hashlib.sha1(value.encode()).hexdigest()[:10]}"[:128]


def converted(pdfs: DataFrame, service: Service) -> DataFrame:
    """path, content (archive; null on failure), error of PDFs (path, content)."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                try:
                    out, error = service.archive(path.rsplit("/", 1)[-1], content), None
                except (ServiceError, OSError, KeyError) as e:
                    out, error = None, str(e)[:500]
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([out], pa.binary()), pa.array([error], pa.string())], ["path", "content", "error"])

    return pdfs.select("path", "content").mapInArrow(convert, "path string, content binary, error string")
