"""Files that grow while they are read, as a stream of lines.

The offset of the stream is, for every file of a folder, the byte after its last
complete line and a fingerprint of its head (SHA-256 of its first ``HEAD``
bytes, or of as many as the offset covers).  A micro-batch holds the lines
between two offsets; a last line without its end waits for it.  A file is known
again by its fingerprint, so a rotated one (``a.csv`` renamed to ``a.csv.1``, a
new ``a.csv`` begun) goes on where it was, and one that was truncated and
written anew starts at its beginning.  Two files whose covered heads are equal
are told apart by name alone.  Ranges beyond ``SPLIT`` bytes are read by
several tasks; a line belongs to the one in whose range it begins.

Columns: value (the line without its end, UTF-8, bad bytes replaced),
source_file, position (byte at which the line begins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMAT = "growing_lines"
HEAD = 4096
SPLIT = 64 << 20


def _source() -> type:
    """The data source; defined here so that it travels to the executors whole."""
    import hashlib
    import io
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import RecordBatch, array, fs, int64, string
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    head, split, name_ = HEAD, SPLIT, FORMAT

    class Range(InputPartition):
        def __init__(self, path: str, first: int, begin: int, end: int) -> None:
            self.path, self.first, self.begin, self.end = path, first, begin, end

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict) -> None:
            self.folder = options["path"]
            self.suffix = options.get("pathSuffix", "")

        def open(self) -> tuple:
            """The file system and the folder in it."""
            return fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (
                fs.LocalFileSystem(), self.folder)

        def listed(self) -> tuple:
            files, folder = self.open()
            found = files.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
            inside = len(folder.rstrip("/")) + 1
            return files, {f.path: f.size for f in found if f.type == fs.FileType.File and f.size
                           and not any(part[0] in "._" for part in f.path[inside:].split("/")) and self.suffix in f.path}

        @staticmethod
        def fingerprint(files: fs.FileSystem, path: str, size: int) -> str:
            with files.open_input_file(path) as f:
                return hashlib.sha256(f.read_at(size, 0)).hexdigest()

        def complete(self, files: fs.FileSystem, path: str, size: int) -> list | None:
            """[end of the last complete line, bytes of its fingerprint, fingerprint]"""
            with files.open_input_file(path) as f:
                at = size
                while at > 0:
                    lo = max(0, at - (1 << 16))
                    found = f.read_at(at - lo, lo).rfind(b"\n")
                    if found >= 0:
                        end = lo + found + 1
                        n = min(head, end)
                        return [end, n, hashlib.sha256(f.read_at(n, 0)).hexdigest()]
                    at = lo
            return None

        def initialOffset(self) -> dict:
            return {}

        def latestOffset(self) -> dict:
            files, sizes = self.listed()
            with ThreadPoolExecutor(16) as pool:
                ends = pool.map(lambda p: self.complete(files, p, sizes[p]), sorted(sizes))
                return {p: e for p, e in zip(sorted(sizes), ends, strict=True) if e}

        def partitions(self, start: dict, end: dict) -> list:
            files, sizes = self.listed()
            seen: dict = {}

            def holds(path: str, record: list) -> bool:
                """Whether the file at ``path`` is the one of ``record``."""
                if sizes.get(path, 0) < record[0]:
                    return False
                key = path, record[1]
                if key not in seen:
                    seen[key] = self.fingerprint(files, path, record[1])
                return seen[key] == record[2]

            changed = {p: e for p, e in end.items() if start.get(p) != e}
            # where the files are now: a batch that is repeated may find them rotated
            places = {p: next((x for x in [p, *sorted(sizes)] if holds(x, e)), None) for p, e in changed.items()}
            lost = sorted(p for p, x in places.items() if x is None)
            if lost:
                raise ValueError(f"files of the batch are gone or changed: {lost}")
            moved = [r for p, r in start.items() if not (p in end and end[p][0] >= r[0] and (
                end[p] == r or holds(places[p], r)))]
            out = []
            for p, e in sorted(changed.items()):
                known = [start[p]] if p in start and start[p] not in moved else moved
                first = max((r[0] for r in known if r[0] <= e[0] and holds(places[p], r)), default=0)
                out += [Range(places[p], first, lo, min(e[0], lo + split)) for lo in range(first, e[0], split)]
            return out or [Range("", 0, 0, 0)]

        def read(self, partition: Range):
            if partition.begin >= partition.end:
                return
            files, _ = self.open()
            with files.open_input_file(partition.path) as raw:
                f = io.BufferedReader(raw, 1 << 20)
                at = partition.begin
                f.seek(at - (at > partition.first))
                if at > partition.first:  # the line that begins earlier belongs to the range before
                    at += len(f.readline()) - 1
                lines, places, size = [], [], 0
                while at < partition.end:
                    line = f.readline()
                    if not line:
                        break
                    lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                    places.append(at)
                    at += len(line)
                    size += len(line)
                    if size > 1 << 22:
                        yield self.batch(partition.path, lines, places)
                        lines, places, size = [], [], 0
                if lines:
                    yield self.batch(partition.path, lines, places)

        @staticmethod
        def batch(path: str, lines: list, places: list) -> RecordBatch:
            return RecordBatch.from_arrays(
                [array(lines, string()), array([path] * len(lines), string()), array(places, int64())],
                ["value", "source_file", "position"])

    class GrowingLines(DataSource):
        @classmethod
        def name(cls) -> str:
            return name_

        def schema(self) -> str:
            return "value string, source_file string, position long"

        def streamReader(self, schema) -> Reader:
            return Reader(self.options)

    return GrowingLines


def growing_lines(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """The lines of the files below ``folder`` (whose path holds ``suffix``), and
    those that they will get, as a stream."""
    spark.dataSource.register(_source())
    return spark.readStream.format(FORMAT).option("pathSuffix", suffix).load(folder)
