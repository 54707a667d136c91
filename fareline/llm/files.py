"""Files of one's own format on the shared storage: temporary names, rename, manifest."""

import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI, for executors and driver alike."""
    return pafs.FileSystem.from_uri(uri)


class Committed:
    """A file that appears under its name only when complete. A repeated task writes the same
    bytes under another temporary name and its rename replaces the file; readers go by the
    manifest, which Spark commits once per task."""

    def __init__(self, uri: str, name: str):
        self.fs, self.root = open_store(uri)
        ctx = TaskContext.get()
        self.fs.create_dir(self.root, recursive=True)
        self.name, self.size = name, 0
        self.tmp = f"{self.root}/.tmp-{ctx.taskAttemptId() if ctx else 0}-{uuid.uuid4().hex[:8]}-{name}"
        self.out = self.fs.open_output_stream(self.tmp, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, f"{self.root}/{self.name}")


def read_all(uri: str, name: str) -> bytes:
    fs, root = open_store(uri)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()


def shard_count(total_bytes: int, parallelism: int, shard_bytes: int = 256 << 20) -> int:
    """Shards by size; for small inputs a few per core as long as each has a megabyte."""
    return max(1, -(-total_bytes // shard_bytes), min(-(-total_bytes // (1 << 20)), 3 * parallelism))
