"""Gridded files (HDF5, and so NetCDF-4) as a Spark source whose partitions are the file's chunks, or stretches of them in large files.

The driver reads the header and the chunk table, a B-tree, of the variables that are asked for; ranges of rows and columns that Spark pushes down drop
chunks there. A task gets the places of its chunks and reads nothing else of the file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from nephogrid.storage import file_system, pushed

# Kinds of header messages, and filters by number.
SPACE, LINKS, TYPE, LINK, LAYOUT, FILTERS, ATTRIBUTE, MORE, TABLE, ATTRIBUTES = 0x1, 0x2, 0x3, 0x6, 0x8, 0xB, 0xC, 0x10, 0x11, 0x15
DEFLATE, SHUFFLE, FLETCHER = 1, 2, 3
NOWHERE = (1 << 64) - 1


@dataclass
class Chunk:
    """Where a chunk's bytes are, which filters were left out (a mask), and its first element."""

    at: int
    size: int
    skipped: int
    origin: tuple[int, ...]


@dataclass
class Variable:
    dtype: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    filters: list[tuple[int, int]]  # number and first value
    index: int  # of the chunk table, or of the data if there are no chunks
    contiguous: bool
    inline: bytes | None = None


class File:
    """The parts of the format that gridded products use: old and new headers and groups, compact, contiguous and chunked data."""

    def __init__(self, path: str):
        store, self.path = file_system(path)
        self.stream = store.open_input_file(self.path)
        head = self.read(0, 128)
        if head[:8] != b"\x89HDF\r\n\x1a\n":
            raise ValueError(f"not an HDF5 file: {path}")
        old = head[8] < 2
        if (head[13:15] if old else head[9:11]) != b"\x08\x08":
            raise ValueError("only files with 8-byte addresses and lengths are read")
        start = 24 if head[8] == 0 else 28
        self.root = struct.unpack_from("<Q", head, start + 40)[0] if old else struct.unpack_from("<Q", head, 36)[0]

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.stream.close()

    def read(self, at: int, size: int) -> bytes:
        return self.stream.read_at(size, at)

    def messages(self, at: int) -> Iterator[tuple[int, bytes]]:
        """(kind, content) of an object's header, over all its blocks."""
        head = self.read(at, 64)
        new = head[:4] == b"OHDR"
        if new:
            flags, p = head[5], 6
            p += 16 * bool(flags & 0x20) + 4 * bool(flags & 0x10)
            width = 1 << (flags & 3)
            blocks, extra = [(at + p + width, int.from_bytes(head[p : p + width], "little"))], 2 * bool(flags & 4)
        else:
            blocks, extra = [(at + 16, struct.unpack_from("<I", head, 8)[0])], 0
        while blocks:
            data, p = self.read(*blocks.pop(0)), 0
            while p + (4 + extra if new else 8) <= len(data):
                kind, size = struct.unpack_from("<BH" if new else "<HH", data, p)
                p += 4 + extra if new else 8
                body = data[p : p + size]
                p += size
                if kind == MORE:
                    where, length = struct.unpack_from("<QQ", body)
                    blocks.append((where + 4, length - 8) if new else (where, length))  # new blocks have a mark before and a checksum behind
                elif kind:
                    yield kind, body

    def links(self, at: int) -> dict[str, int]:
        """Names and headers of what a group holds."""
        found = {}
        for kind, body in self.messages(at):
            if kind == TABLE:
                tree, heap = struct.unpack_from("<QQ", body)
                names = self.read(struct.unpack_from("<Q", self.read(heap, 32), 24)[0], struct.unpack_from("<Q", self.read(heap, 32), 8)[0])
                for node in self._symbol_nodes(tree):
                    for i in range(struct.unpack_from("<H", self.read(node, 8), 6)[0]):
                        name, where = struct.unpack("<QQ", self.read(node + 8 + 40 * i, 16))
                        found[names[name : names.index(b"\0", name)].decode()] = where
            elif kind == LINK:
                found |= self._link(body)
            elif kind == LINKS:
                heap, tree = struct.unpack_from("<QQ", body, 2 + 8 * (body[1] & 1))
                for record in self._records(tree) if heap != NOWHERE else ():
                    found |= self._link(self._heap_object(heap, record[4:]))
        return found

    def _symbol_nodes(self, at: int) -> Iterator[int]:
        _, level, used = struct.unpack("<BBH", self.read(at + 4, 4))
        for i in range(used):
            child = struct.unpack("<Q", self.read(at + 24 + 16 * i + 8, 8))[0]
            yield from self._symbol_nodes(child) if level else (child,)

    @staticmethod
    def _link(body: bytes) -> dict[str, int]:
        flags, p, kind = body[1], 2, 0
        if flags & 8:
            kind, p = body[p], p + 1
        p += 8 * bool(flags & 4) + bool(flags & 16)
        width = 1 << (flags & 3)
        size, p = int.from_bytes(body[p : p + width], "little"), p + width
        return {} if kind else {body[p : p + size].decode(): struct.unpack_from("<Q", body, p + size)[0]}

    def _records(self, at: int) -> Iterator[bytes]:
        """Records of a newer B-tree, of one leaf or of a node above leaves."""
        head = self.read(at, 38)
        node_size, record, depth = struct.unpack_from("<IHH", head, 6)
        root, used = struct.unpack_from("<QH", head, 16)
        if root == NOWHERE:
            return
        if depth > 1:
            raise ValueError("a list of names this long is not read")
        data = self.read(root, node_size)
        yield from (data[6 + record * i : 6 + record * (i + 1)] for i in range(used))
        count = (((node_size - 10) // record).bit_length() + 7) // 8  # bytes of a leaf's number of records
        for i in range(used + 1 if depth else 0):
            p = 6 + record * used + (8 + count) * i
            leaf = self.read(struct.unpack_from("<Q", data, p)[0], node_size)
            yield from (leaf[6 + record * k : 6 + record * (k + 1)] for k in range(int.from_bytes(data[p + 8 : p + 8 + count], "little")))

    def _heap_object(self, heap: int, key: bytes) -> bytes:
        """An object of a fractal heap by its key, in its root block or in blocks right below."""
        h = self.read(heap, 146)
        managed = struct.unpack_from("<I", h, 10)[0]
        width, first, largest, bits = struct.unpack_from("<HQQH", h, 110)
        root, rows = struct.unpack_from("<QH", h, 132)
        if key[0] >> 4 & 3:
            raise ValueError("an object of this heap is stored apart")
        at_size, length_size = (bits + 7) // 8, (min(largest, managed).bit_length() + 7) // 8
        offset, size = int.from_bytes(key[1 : 1 + at_size], "little"), int.from_bytes(key[1 + at_size : 1 + at_size + length_size], "little")
        if not rows:
            return self.read(root + offset, size)
        begin, block, table = 0, root + 13 + at_size, 0
        for row in range(rows):
            room = first << max(0, row - 1)
            if room > largest:
                break
            for _ in range(width):
                if begin <= offset < begin + room:
                    return self.read(struct.unpack("<Q", self.read(block + 8 * table, 8))[0] + offset - begin, size)
                begin, table = begin + room, table + 1
        raise ValueError("this heap is deeper than is read")

    def _dtype(self, body: bytes) -> str:
        kind, order, size = body[0] & 15, ">" if body[1] & 1 else "<", struct.unpack_from("<I", body, 4)[0]
        if kind == 3:
            return f"S{size}"
        if kind == 9:
            return "vlen"
        if kind not in (0, 1) or size not in (1, 2, 4, 8):
            raise ValueError(f"type {kind} of {size} bytes is not read")
        return f"{order}{'f' if kind else 'i' if body[1] & 8 else 'u'}{size}"

    @staticmethod
    def _shape(body: bytes) -> tuple[int, ...]:
        return struct.unpack_from(f"<{body[1]}Q", body, 8 if body[0] == 1 else 4)

    def attributes(self, at: int) -> dict[str, object]:
        """An object's attributes of numbers and texts; others are left out."""
        found = {}
        for kind, body in self.messages(at):
            bodies = [body] if kind == ATTRIBUTE else []
            if kind == ATTRIBUTES:
                heap, tree = struct.unpack_from("<QQ", body, 2 + 2 * (body[1] & 1))
                bodies = [self._heap_object(heap, r[:8]) for r in self._records(tree)] if heap != NOWHERE else []
            for b in bodies:
                sizes, p = struct.unpack_from("<HHH", b, 2), 9 if b[0] == 3 else 8
                parts = []
                for n in sizes:
                    parts.append(b[p : p + n])
                    p += -(-n // 8) * 8 if b[0] == 1 else n
                try:
                    dtype, shape = self._dtype(parts[1]), self._shape(parts[2])
                except ValueError:
                    continue
                name, n = parts[0].rstrip(b"\0").decode(), int(np.prod(shape, dtype=np.int64))
                if dtype == "vlen":
                    found[name] = self._text(*struct.unpack_from("<IQI", b, p)) if n else ""
                elif dtype[0] == "S":
                    found[name] = b[p : p + int(dtype[1:]) * n].split(b"\0")[0].decode("utf-8", "replace")
                else:
                    value = np.frombuffer(b, dtype, n, p)
                    found[name] = value.item() if n == 1 else value.tolist()
        return found

    def _text(self, size: int, at: int, number: int) -> str:
        """A text of a heap that the whole file shares."""
        length, p = struct.unpack_from("<Q", self.read(at, 16), 8)[0], 16
        data = self.read(at, length)
        while p + 16 <= length:
            own, _, _, n = struct.unpack_from("<HHIQ", data, p)
            if own == number:
                return data[p + 16 : p + 16 + size].decode("utf-8", "replace")
            if not own:
                break
            p += 16 + -(-n // 8) * 8
        return ""

    def variable(self, at: int) -> Variable | None:
        """What a data set is; none for a group."""
        dtype = shape = layout = None
        filters: list[tuple[int, int]] = []
        for kind, body in self.messages(at):
            if kind == SPACE:
                shape = self._shape(body)
            elif kind == TYPE:
                try:
                    dtype = self._dtype(body)
                except ValueError:
                    return None
            elif kind == LAYOUT:
                layout = body
            elif kind == FILTERS:
                p = 8 if body[0] == 1 else 2
                for _ in range(body[1]):
                    number, p = struct.unpack_from("<H", body, p)[0], p + 2
                    name = 0
                    if body[0] == 1 or number >= 256:
                        name, p = struct.unpack_from("<H", body, p)[0], p + 2
                    _, n = struct.unpack_from("<HH", body, p)
                    p += 4 + (-(-name // 8) * 8 if body[0] == 1 else name)
                    filters.append((number, struct.unpack_from("<I", body, p)[0] if n else 0))
                    p += 4 * n + 4 * (body[0] == 1 and n % 2)
        if layout is None or shape is None or dtype is None or dtype[0] in "Sv":
            return None
        if layout[0] not in (3, 4) or layout[0] == 4 and layout[1] == 2:
            raise ValueError(f"layout {layout[0]} with class {layout[1]} is not read")
        if layout[1] == 0:
            return Variable(dtype, shape, shape, [], 0, True, layout[4 : 4 + struct.unpack_from("<H", layout, 2)[0]])
        if layout[1] == 1:
            return Variable(dtype, shape, shape, [], struct.unpack_from("<Q", layout, 2)[0], True)
        rank = layout[2] - 1
        return Variable(dtype, shape, struct.unpack_from(f"<{rank}I", layout, 11), filters, struct.unpack_from("<Q", layout, 3)[0], False)

    def chunks(self, v: Variable, low: list[int], high: list[int]) -> list[Chunk]:
        """The stored chunks that meet [low, high), found from the root of their table; branches before and after are not read."""
        rank, found = len(v.shape), []
        key = 8 + 8 * (rank + 1)

        def walk(node: int) -> None:
            _, level, used = struct.unpack("<BBH", self.read(node + 4, 4))
            data = self.read(node + 24, used * (key + 8) + key)
            origins = [struct.unpack_from(f"<{rank}Q", data, (key + 8) * i + 8) for i in range(used + 1)]
            for i in range(used):
                child = struct.unpack_from("<Q", data, (key + 8) * i + key)[0]
                if level:
                    # a branch has chunks from its key to before the next, in order of rows first
                    if origins[i][0] < high[0] and origins[i + 1][0] + v.chunk[0] > low[0]:
                        walk(child)
                elif all(o < h and o + c > a for o, c, a, h in zip(origins[i], v.chunk, low, high, strict=True)):
                    found.append(Chunk(child, *struct.unpack_from("<II", data, (key + 8) * i), origins[i]))

        if v.index != NOWHERE:
            walk(v.index)
        return found

    def block(self, v: Variable, chunks: list[Chunk], low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The values of [low, high), and which of them are stored."""
        shape = [h - a for a, h in zip(low, high, strict=True)]
        out, there = np.zeros(shape, v.dtype), np.zeros(shape, bool)
        if v.contiguous:
            # layers before rows and columns are single, so rows follow each other
            first, row = (low[-2], v.shape[-1]) if len(shape) > 1 else (low[0], 1)
            n, size = (shape[-2] if len(shape) > 1 else shape[0]), row * out.itemsize
            if v.inline is not None or v.index != NOWHERE:
                raw = v.inline[first * size : (first + n) * size] if v.inline is not None else self.read(v.index + first * size, n * size)
                values = np.frombuffer(raw, v.dtype).reshape(n, row)
                out[...] = (values[:, low[-1] : high[-1]] if len(shape) > 1 else values).reshape(shape)
                there[...] = True
            return out, there
        for c in chunks:
            data = self.read(c.at, c.size)
            for i, (number, value) in reversed(list(enumerate(v.filters))):
                if c.skipped >> i & 1:
                    continue
                if number == DEFLATE:
                    data = zlib.decompress(data)
                elif number == SHUFFLE:
                    n = len(data) // (value or out.itemsize)
                    data = np.frombuffer(data, np.uint8, n * (value or out.itemsize)).reshape(-1, n).T.tobytes()
                elif number == FLETCHER:
                    data = data[:-4]
                else:
                    raise ValueError(f"filter {number} is not read")
            values = np.frombuffer(data, v.dtype).reshape(v.chunk)
            to, of = [], []
            for o, w, a, h in zip(c.origin, v.chunk, low, high, strict=True):
                to.append(slice(max(o, a) - a, min(o + w, h) - a))
                of.append(slice(max(o, a) - o, min(o + w, h) - o))
            out[tuple(to)], there[tuple(to)] = values[tuple(of)], True
        return out, there


#: Partitions of a grid; beyond this number chunks that follow each other share one.
MOST_PARTS = 512


@dataclass
class GridPart:
    """Rows [low, high) and columns [left, right), and for each variable the chunks it has there."""

    low: int
    high: int
    left: int
    right: int
    chunks: dict[str, list[Chunk]]


@dataclass
class GridParts(InputPartition):
    parts: list[GridPart]


class GridReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path = options["path"]
        self.names = [f.name for f in schema if f.name not in ("r", "c")]
        self.step = int(options.get("rowsPerPartition", "256"))  # of variables without chunks
        self.bounds = {"r": [0, None], "c": [0, None]}
        with File(self.path) as f:
            links = f.links(f.root)
            self.variables = {n: f.variable(links[n]) for n in self.names if n in links}
            said = {n: f.attributes(links[n]) for n in self.variables}
        value = lambda n, option, attribute: options.get(f"{option}.{n}", said.get(n, {}).get(attribute))
        number = lambda x, other: other if x is None else float(x)
        self.scale = {n: number(value(n, "scale", "scale_factor"), 1.0) for n in self.names}
        self.offset = {n: number(value(n, "offset", "add_offset"), 0.0) for n in self.names}
        self.fill = {n: number(value(n, "fill", "_FillValue"), None) for n in self.names}
        if missing := [n for n in self.names if self.variables.get(n) is None]:
            raise ValueError(f"the file has no variables named {missing}")
        grids = [n for n in self.names if len(self.variables[n].shape) > 1]
        if not grids:
            raise ValueError("a grid needs a variable of rows and columns")
        self.first, self.shape = grids[0], self.variables[grids[0]].shape[-2:]
        if any(self.variables[n].shape[-2:] != self.shape or max(self.variables[n].shape[:-2], default=1) > 1 for n in grids):
            raise ValueError("the grids differ in shape, or have more than one layer")

    def partitions(self):
        (height, width), v = self.shape, self.variables[self.first]
        low, left = self.bounds["r"][0], self.bounds["c"][0]
        high, right = (n if b[1] is None else min(n, b[1]) for n, b in ((height, self.bounds["r"]), (width, self.bounds["c"])))
        rows, columns = (self.step, width) if v.contiguous else v.chunk[-2:]
        parts = [GridPart(max(low, y), min(high, y + rows), max(left, x), min(right, x + columns), {}) for y in range(low - low % rows, high, rows) for x in range(left - left % columns, right, columns)]
        parts = [p for p in parts if p.low < p.high and p.left < p.right]
        by_place = {(p.low // rows, p.left // columns): p for p in parts}
        lines, across = sorted({y for y, _ in by_place}), sorted({x for _, x in by_place})
        with File(self.path) as f:
            for n, own in self.variables.items():
                if own.contiguous or not parts:
                    continue
                for p in parts:
                    p.chunks[n] = []
                # the table is read once, and a chunk goes to the parts it meets
                for c in f.chunks(own, *self._box(own, low, high, left, right)):
                    meets = lambda i, step, there: range(max(there[0], c.origin[i] // step), min(there[-1], (c.origin[i] + own.chunk[i] - 1) // step) + 1)  # noqa: B023, E731
                    by_row = len(own.shape) > 1 or own.shape[0] == self.shape[0]
                    ys = meets(-2 if len(own.shape) > 1 else 0, rows, lines) if by_row else lines
                    xs = meets(-1, columns, across) if len(own.shape) > 1 or not by_row else across
                    for y in ys:
                        for x in xs:
                            by_place[y, x].chunks[n].append(c)
        each = -(-len(parts) // MOST_PARTS)
        return [GridParts(parts[i : i + each]) for i in range(0, len(parts), each)] if parts else [GridParts([])]

    def _box(self, v: Variable, low: int, high: int, left: int, right: int) -> tuple[list[int], list[int]]:
        if len(v.shape) == 1:
            return ([low], [high]) if v.shape[0] == self.shape[0] else ([left], [right])
        layers = len(v.shape) - 2
        return [0] * layers + [low, left], [1] * layers + [high, right]

    def read(self, partition):
        import pyarrow as pa

        with File(self.path) as f:
            for p in partition.parts:
                yield from self._batches(pa, f, p)

    def _batches(self, pa, f: File, p: GridPart):
        columns = {}
        n_rows, n_columns = p.high - p.low, p.right - p.left
        for n, v in self.variables.items():
            raw, there = f.block(v, p.chunks.get(n, []), *self._box(v, p.low, p.high, p.left, p.right))
            if len(v.shape) == 1:
                by_row = v.shape[0] == self.shape[0]
                raw, there = (np.broadcast_to(x[:, None] if by_row else x[None, :], (n_rows, n_columns)) for x in (raw, there))
            raw, there = raw.reshape(n_rows, n_columns), there.reshape(n_rows, n_columns)
            value = raw.astype(np.float64) * self.scale[n] + self.offset[n]
            missing = np.isnan(value) | ~there if self.fill[n] is None else np.isnan(value) | ~there | (raw == self.fill[n])
            columns[n] = (value, missing)
        step = max(1, (1 << 16) // max(1, n_columns))
        for a in range(0, n_rows, step):
            z = min(n_rows, a + step)
            rows = {n: pa.array(v[a:z].reshape(-1), pa.float64(), mask=m[a:z].reshape(-1)) for n, (v, m) in columns.items()}
            r = np.repeat(np.arange(p.low + a, p.low + z, dtype=np.int32), n_columns)
            yield pa.RecordBatch.from_pydict({"r": pa.array(r), "c": pa.array(np.tile(np.arange(p.left, p.right, dtype=np.int32), z - a)), **rows})


class PushedGridReader(GridReader):
    def pushFilters(self, filters):
        for f in filters:
            kind, name = type(f).__name__, (getattr(f, "attribute", None) or [None])[0]
            if name not in self.bounds or kind not in ("GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual", "EqualTo"):
                yield f
                continue
            low, high = self.bounds[name]
            if kind.startswith("Greater") or kind == "EqualTo":
                low = max(low, f.value + (kind == "GreaterThan"))
            if kind.startswith("Less") or kind == "EqualTo":
                past = f.value + (kind != "LessThan")
                high = past if high is None else min(high, past)
            self.bounds[name] = [low, high]


class GriddedFile(DataSource):
    """``spark.read.format("netcdf_grid").schema("r int, c int, bt double").option("scale.bt", "0.01").load(path)``.

    Register with ``spark.dataSource.register(GriddedFile)``. Only the schema's variables are read; those of one dimension are coordinates of rows or
    columns (of rows if it could be either). A variable has rows and columns and may have dimensions of one layer before. Values are scaled as the file's
    attributes say, or the options ``scale.NAME``, ``offset.NAME`` and ``fill.NAME``; null are NaN, the fill value, and what the file does not store.
    Ranges of ``r`` and ``c`` are pushed.
    """

    @classmethod
    def name(cls):
        return "netcdf_grid"

    def schema(self):
        raise ValueError("name the variables in a schema: r int, c int and a double for each")

    def reader(self, schema):
        return (PushedGridReader if self.options.get("pushed", "true") == "true" else GridReader)(schema, self.options)


def read_grid(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """The variables that a schema (r int, c int, and a double for each) names, with the options of ``GriddedFile``."""
    spark.dataSource.register(GriddedFile)
    return spark.read.format("netcdf_grid").schema(schema).options(pushed=pushed(spark), **options).load(path)


def grid_info(spark: SparkSession, path: str) -> DataFrame:
    """One row of a file's header: (names, long_names, stamp, height, width); names are the variables of two dimensions and more."""
    with File(path) as f:
        found = {n: v for n, at in f.links(f.root).items() if (v := f.variable(at)) and len(v.shape) > 1}
        if not found:
            raise ValueError(f"no variable of {path} has rows and columns")
        links = f.links(f.root)
        row = (list(found), [str(f.attributes(links[n]).get("long_name", "")) for n in found], str(f.attributes(f.root).get("time_coverage_start", "")), *map(int, next(iter(found.values())).shape[-2:]))
    return spark.createDataFrame([row], "names array<string>, long_names array<string>, stamp string, height int, width int")
