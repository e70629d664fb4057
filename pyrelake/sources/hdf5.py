"""Gridded files in the HDF5-based format: what is needed to read variables on their dimensions, chunk by chunk.

Read are superblocks 0 to 3, object headers 1 and 2, groups as symbol tables or as links, links and attributes in object
headers or, where there are many, in heaps of their own,
whole numbers, floats, strings and references, and data that is compact, contiguous, or chunked under a version 1 tree, with
deflate, shuffle and checksum filters. What a file has beyond that (newer
chunk indexes, other filters, filtered heaps) is refused by name, never skipped. Files are opened once and read at places: headers, the
chunk tree, and the chunks of the slice that is asked for.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

SIGNATURE = b"\x89HDF\r\n\x1a\n"
_NOWHERE = 2**64 - 1
#: Kinds of messages in object headers, and of filters.
_SPACE, _LINK_INFO, _TYPE, _FILL, _LINK, _LAYOUT, _FILTERS, _ATTRIBUTE, _CONTINUED, _SYMBOLS, _ATTRIBUTE_INFO = 1, 2, 3, 5, 6, 8, 11, 12, 16, 17, 21
_DEFLATE, _SHUFFLE, _CHECKSUM = 1, 2, 3


class Unsupported(ValueError):
    """A file that is well formed, as far as is known, but not read here."""


@dataclass
class Kind:
    """A datatype: dtype of numbers; text, ref (8 bytes) or vlen (of another kind) otherwise; None for kinds that are not read."""

    size: int
    dtype: np.dtype | None = None
    what: str = "number"
    of: Kind | None = None


@dataclass
class Dataset:
    shape: list[int]
    kind: Kind
    attrs: dict
    layout: tuple = ()
    filters: list = field(default_factory=list)
    fill: bytes | None = None
    dims: list[str] = field(default_factory=list)
    chunk: list[int] | None = None

    @property
    def dtype(self) -> np.dtype:
        return self.kind.dtype


@dataclass
class Chunk:
    address: int
    size: int
    mask: int
    at: tuple[int, ...]


class Hdf5:
    """The variables of a file's root group by name, their dimensions' lengths, and slices along the first two dimensions."""

    def __init__(self, path: str, file):
        self.path, self.file, self.heaps, self.trees = path, file, {}, {}
        raw = file.read_at(112, 0)
        if raw[:8] != SIGNATURE or raw[8] > 3:
            raise ValueError(f"{path}: not an HDF5-based file")
        sizes = raw[13:15] if raw[8] < 2 else raw[9:11]
        if sizes != b"\x08\x08":
            raise Unsupported(f"{path}: addresses of other than eight bytes")
        if raw[8] < 2:
            root = struct.unpack_from("<Q", raw, 24 + 4 * raw[8] + 32 + 8)[0]
        else:
            root = struct.unpack_from("<Q", raw, 36)[0]
        names = self._links(root)
        found = {name: self._dataset(address) for name, address in names.items()}
        found = {name: d for name, d in found.items() if d is not None}
        self.attrs = {}
        self.lengths: dict[str, int] = {}
        scales = {names[n]: n for n, d in found.items() if d.attrs.get("CLASS") == "DIMENSION_SCALE"}
        for address, n in scales.items():
            self.lengths[n] = found[n].shape[0]
        for n, d in found.items():
            d.dims = [n] if names[n] in scales and len(d.shape) == 1 else self._dims(d, scales)
        bare = lambda d: str(d.attrs.get("NAME", "")).startswith("This is a netCDF dimension but not a netCDF variable")
        self.variables = {n: d for n, d in found.items() if not bare(d)}

    def _at(self, address: int, n: int) -> bytes:
        raw = self.file.read_at(n, address)
        if len(raw) < n:
            raise ValueError(f"{self.path}: ends at byte {address + len(raw)}")
        return raw

    def _dims(self, d: Dataset, scales: dict[int, str]) -> list[str]:
        """The names of a variable's dimensions: as listed, or as the only scale of that length."""
        listed = d.attrs.get("DIMENSION_LIST")
        if listed is not None:
            named = [scales.get(struct.unpack("<Q", x[:8])[0]) if x else None for x in listed]
            if len(named) == len(d.shape) and None not in named:
                return named
        out = []
        for n in d.shape:
            fits = [name for name, length in self.lengths.items() if length == n]
            out.append(fits[0] if len(fits) == 1 else f"of_{n}")
        return out

    # object headers

    def _messages(self, address: int) -> list[tuple[int, bytes]]:
        """(kind, body) of an object header's messages, continuations included."""
        raw, out = self._at(address, 16), []
        if raw[:4] != b"OHDR":
            if raw[0] != 1:
                raise ValueError(f"{self.path}: no object header at {address}")
            blocks = [(address + 16, struct.unpack_from("<I", raw, 8)[0])]
            for at, size in blocks:
                body, k = self._at(at, size), 0
                while k + 8 <= size:
                    kind, n, flags = struct.unpack_from("<HHB", body, k)
                    self._message(kind, body[k + 8 : k + 8 + n], flags, out, blocks, 0)
                    k += 8 + n
            return out
        flags, at = raw[5], address + 6 + (16 if raw[5] & 32 else 0) + (4 if raw[5] & 16 else 0)
        width = 1 << (flags & 3)
        size = int.from_bytes(self._at(at, width), "little")
        blocks, head = [(at + width, size)], 6 if flags & 4 else 4
        for at, size in blocks:
            body, k = self._at(at, size), 0
            while k + head <= size:
                kind, n, own = struct.unpack_from("<BHB", body, k)
                self._message(kind, body[k + head : k + head + n], own, out, blocks, 4)
                k += head + n
        return out

    def _message(self, kind: int, body: bytes, flags: int, out: list, blocks: list, frame: int) -> None:
        if kind == _CONTINUED:
            at, size = struct.unpack_from("<QQ", body)
            blocks.append((at + frame, size - 2 * frame))  # a signature before, a checksum behind
        elif flags & 2 and kind in (_SPACE, _TYPE, _FILL, _FILTERS):
            raise Unsupported(f"{self.path}: shared messages")
        else:
            out.append((kind, body))

    def _links(self, address: int) -> dict[str, int]:
        """Names and object headers in a group."""
        out = {}
        for kind, body in self._messages(address):
            if kind == _SYMBOLS:
                tree, heap = struct.unpack_from("<QQ", body)
                names = struct.unpack_from("<Q", self._at(heap, 32), 24)[0]
                self._symbols(tree, names, out)
            elif kind == _LINK:
                self._link(body, out)
            elif kind == _LINK_INFO:
                at = 2 + (8 if body[1] & 1 else 0)
                for link in self._dense(*struct.unpack_from("<QQ", body, at)):
                    self._link(link, out)
        return out

    def _symbols(self, node: int, names: int, out: dict) -> None:
        head = self._at(node, 24)
        entries = struct.unpack_from("<H", head, 6)[0]
        if head[:4] == b"TREE":
            body = self._at(node + 24, 16 * entries + 8)
            for k in range(entries):
                self._symbols(struct.unpack_from("<Q", body, 16 * k + 8)[0], names, out)
        else:
            body = self._at(node + 8, 40 * entries)
            for k in range(entries):
                name, address = struct.unpack_from("<QQ", body, 40 * k)
                out[self._text(names + name)] = address

    def _text(self, address: int) -> str:
        raw = b""
        while b"\0" not in raw:
            more = self.file.read_at(64, address + len(raw))
            if not more:
                raise ValueError(f"{self.path}: a name without an end")
            raw += more
        return raw[: raw.index(b"\0")].decode("utf-8", "replace")

    def _link(self, body: bytes, out: dict) -> None:
        flags, at = body[1], 2
        kind = 0
        if flags & 8:
            kind, at = body[at], at + 1
        at += (8 if flags & 4 else 0) + (1 if flags & 16 else 0)
        width = 1 << (flags & 3)
        n = int.from_bytes(body[at : at + width], "little")
        name = body[at + width : at + width + n].decode("utf-8", "replace")
        if kind == 0:  # soft and external links lead to no variable of this file
            out[name] = struct.unpack_from("<Q", body, at + width + n)[0]

    def _dataset(self, address: int) -> Dataset | None:
        """What an object header says of a dataset; None for groups and named types."""
        messages = self._messages(address)
        kinds = {k for k, _ in messages}
        if not {_SPACE, _TYPE, _LAYOUT} <= kinds:
            return None
        out = Dataset([], Kind(0), {})
        for kind, body in messages:
            if kind == _SPACE:
                out.shape = self._space(body)
            elif kind == _TYPE:
                out.kind = self._type(body)[0]
            elif kind == _LAYOUT:
                out.layout = self._layout(body)
            elif kind == _FILTERS:
                out.filters = self._filters(body)
            elif kind == _FILL:
                out.fill = self._fill(body)
            elif kind == _ATTRIBUTE:
                name, value = self._attribute(body)
                out.attrs[name] = value
            elif kind == _ATTRIBUTE_INFO:
                at = 2 + (2 if body[1] & 1 else 0)
                for one in self._dense(*struct.unpack_from("<QQ", body, at)):
                    name, value = self._attribute(one)
                    out.attrs[name] = value
        if out.layout[0] == "chunked":
            out.chunk = list(out.layout[2])
        return out

    @staticmethod
    def _space(body: bytes) -> list[int]:
        n, at = body[1], 8 if body[0] == 1 else 4
        return list(struct.unpack_from(f"<{n}Q", body, at))

    def _type(self, body: bytes) -> tuple[Kind, int]:
        """A datatype and its length in bytes where that is known."""
        kind, size = body[0] & 15, struct.unpack_from("<I", body, 4)[0]
        order = ">" if body[1] & 1 else "<"
        if kind == 0:
            return Kind(size, np.dtype(f"{order}{'i' if body[1] & 8 else 'u'}{size}")), 12
        if kind == 1:
            return Kind(size, np.dtype(f"{order}f{size}")), 20
        if kind == 3:
            return Kind(size, None, "text"), 8
        if kind == 7:
            return Kind(size, None, "ref"), 8
        if kind == 9:
            return Kind(size, None, "vlen text" if body[1] & 15 == 1 else "vlen", self._type(body[8:])[0]), 8
        return Kind(size, None, "other"), len(body)

    def _layout(self, body: bytes) -> tuple:
        if body[0] != 3:
            raise Unsupported(f"{self.path}: data layouts of version {body[0]}")
        if body[1] == 0:
            n = struct.unpack_from("<H", body, 2)[0]
            return "compact", body[4 : 4 + n]
        if body[1] == 1:
            return ("contiguous", *struct.unpack_from("<QQ", body, 2))
        n = body[2]
        return "chunked", struct.unpack_from("<Q", body, 3)[0], struct.unpack_from(f"<{n - 1}I", body, 11)

    def _filters(self, body: bytes) -> list[tuple[int, tuple[int, ...]]]:
        out, at = [], 8 if body[0] == 1 else 2
        for _ in range(body[1]):
            kind = struct.unpack_from("<H", body, at)[0]
            named = body[0] == 1 or kind >= 256
            length = struct.unpack_from("<H", body, at + 2)[0] if named else 0
            at += 4 if named else 2
            _, n = struct.unpack_from("<HH", body, at)
            at += 4 + (-(-length // 8) * 8 if body[0] == 1 else length)
            out.append((kind, struct.unpack_from(f"<{n}I", body, at)))
            at += 4 * n + (4 if body[0] == 1 and n % 2 else 0)
            if kind not in (_DEFLATE, _SHUFFLE, _CHECKSUM):
                raise Unsupported(f"{self.path}: filter {kind}")
        return out

    @staticmethod
    def _fill(body: bytes) -> bytes | None:
        if body[0] == 3:
            at = 2 if body[1] & 32 else None
        else:
            at = 4 if body[0] == 1 or body[3] else None
        if at is None:
            return None
        n = struct.unpack_from("<I", body, at)[0]
        return body[at + 4 : at + 4 + n] or None

    # attributes

    def _attribute(self, body: bytes):
        version, flags = body[0], body[1] if body[0] > 1 else 0
        sizes = struct.unpack_from("<HHH", body, 2)
        at, step = (9 if version == 3 else 8), 8 if version == 1 else 1
        parts = []
        for n in sizes:
            parts.append(body[at : at + n])
            at += -(-n // step) * step
        name = parts[0].split(b"\0")[0].decode("utf-8", "replace")
        if flags & 1:
            return name, None
        kind, shape = self._type(parts[1])[0], self._space(parts[2])
        return name, self._value(kind, shape, body[at:])

    def _value(self, kind: Kind, shape: list[int], raw: bytes):
        n = int(np.prod(shape, dtype=np.int64))
        if kind.what == "number":
            return np.frombuffer(raw[: n * kind.size], kind.dtype)
        each = [raw[k * kind.size : (k + 1) * kind.size] for k in range(n)]
        if kind.what == "text":
            texts = [x.split(b"\0")[0].decode("utf-8", "replace") for x in each]
        elif kind.what.startswith("vlen"):
            items = [self._heaped(x) for x in each]
            if kind.what == "vlen":
                return items
            texts = [x.decode("utf-8", "replace").rstrip("\0") for x in items]
        else:
            return None
        return texts[0] if len(texts) == 1 else texts

    def _heaped(self, raw: bytes) -> bytes:
        """A value of varying length, from its heap."""
        _, address, index = struct.unpack_from("<IQI", raw)
        if address not in self.heaps:
            size = struct.unpack_from("<Q", self._at(address, 16), 8)[0]
            body, at, found = self._at(address, size), 16, {}
            while at + 16 <= size:
                k, n = struct.unpack_from("<H6xQ", body, at)
                if k == 0:
                    break
                found[k] = body[at + 16 : at + 16 + n]
                at += 16 + -(-n // 8) * 8
            self.heaps[address] = found
        return self.heaps[address].get(index, b"")

    # many links or attributes: their messages are in a fractal heap, and a version 2 tree has their places by name

    def _dense(self, heap: int, tree: int) -> list[bytes]:
        """The messages in a heap that a tree of names lists; none where there is no heap."""
        if heap == _NOWHERE:
            return []
        head = self._at(tree, 38)
        if head[:4] != b"BTHD" or head[5] not in (5, 8):
            raise ValueError(f"{self.path}: no tree of names at {tree}")
        node, size, depth = struct.unpack_from("<IHH", head, 6)
        root, n = struct.unpack_from("<QH", head, 16)
        start = 4 if head[5] == 5 else 0  # a link's place follows its name's hash
        places = [r[start:] for r in self._records(root, n, depth, node, size)]
        read = self._heap(heap)
        return [read(p) for p in places]

    def _records(self, at: int, n: int, depth: int, node: int, size: int) -> list[bytes]:
        if n == 0:
            return []
        body = self._at(at, node)
        own = [body[6 + k * size : 6 + (k + 1) * size] for k in range(n)]
        if depth == 0:
            return own
        if depth > 1:
            raise Unsupported(f"{self.path}: a tree of names of more than two levels")
        width = -(-((node - 10) // size).bit_length() // 8)  # of the number of a leaf's records
        for k in range(n + 1):
            child = 6 + n * size + k * (8 + width)
            address = struct.unpack_from("<Q", body, child)[0]
            own += self._records(address, int.from_bytes(body[child + 8 : child + 8 + width], "little"), 0, node, size)
        return own

    def _heap(self, at: int):
        """A function: place in the heap -> the message there."""
        head = self._at(at, 142)
        if head[:4] != b"FRHP":
            raise ValueError(f"{self.path}: no heap at {at}")
        if struct.unpack_from("<H", head, 7)[0]:
            raise Unsupported(f"{self.path}: a filtered heap")
        largest = struct.unpack_from("<I", head, 10)[0]
        width, first, most, bits = struct.unpack_from("<HQQH", head, 110)
        root, rows = struct.unpack_from("<QH", head, 132)
        o = -(-bits // 8)
        n = -(-min(most, largest).bit_length() // 8)
        blocks: list[tuple[int, int, int]] = []  # offset in the heap, length, address

        def spread(block: int, offset: int, rows: int) -> None:
            body = self._at(block, 13 + o + 8 * rows * width)
            for row in range(rows):
                length = first << max(0, row - 1)
                for k in range(width):
                    address = struct.unpack_from("<Q", body, 13 + o + 8 * (row * width + k))[0]
                    if address != _NOWHERE:
                        if length > most:
                            raise Unsupported(f"{self.path}: a heap of more than two levels")
                        blocks.append((offset, length, address))
                    offset += length

        if rows:
            spread(root, 0, rows)
        elif root != _NOWHERE:
            blocks.append((0, first, root))

        def read(place: bytes) -> bytes:
            kind = place[0] >> 4 & 3
            if kind == 2:
                return place[1 : 2 + (place[0] & 15)]
            if kind == 1:
                raise Unsupported(f"{self.path}: huge messages")
            offset, length = int.from_bytes(place[1 : 1 + o], "little"), int.from_bytes(place[1 + o : 1 + o + n], "little")
            begin, _, address = next(b for b in blocks if b[0] <= offset < b[0] + b[1])
            return self._at(address + offset - begin, length)

        return read

    # data

    def chunks(self, name: str) -> list[Chunk]:
        """Where a variable's chunks are, read once."""
        if name not in self.trees:
            d, out = self.variables[name], []
            if d.layout[1] != _NOWHERE:
                self._tree(d.layout[1], len(d.shape), out)
            self.trees[name] = out
        return self.trees[name]

    def _tree(self, node: int, dims: int, out: list) -> None:
        head = self._at(node, 24)
        if head[:4] != b"TREE" or head[4] != 1:
            raise ValueError(f"{self.path}: no chunk tree at {node}")
        entries, key = struct.unpack_from("<H", head, 6)[0], 8 + 8 * (dims + 1)
        body = self._at(node + 24, entries * (key + 8))
        for k in range(entries):
            size, mask = struct.unpack_from("<II", body, k * (key + 8))
            at = struct.unpack_from(f"<{dims}Q", body, k * (key + 8) + 8)
            address = struct.unpack_from("<Q", body, k * (key + 8) + key)[0]
            if head[5]:
                self._tree(address, dims, out)
            else:
                out.append(Chunk(address, size, mask, at))

    def _decoded(self, d: Dataset, chunk: Chunk) -> np.ndarray:
        raw = self._at(chunk.address, chunk.size)
        for k in reversed(range(len(d.filters))):
            if chunk.mask >> k & 1:
                continue
            kind, values = d.filters[k]
            if kind == _CHECKSUM:
                raw = raw[:-4]
            elif kind == _DEFLATE:
                raw = zlib.decompress(raw)
            else:
                width = values[0] if values else d.kind.size
                whole = len(raw) // width * width
                raw = np.frombuffer(raw[:whole], np.uint8).reshape(width, -1).T.tobytes() + raw[whole:]
        return np.frombuffer(raw, d.dtype).reshape(d.chunk)

    def read(self, name: str, first: int = 0, last: int | None = None, rows: tuple[int, int] | None = None) -> np.ndarray:
        """A variable's places first to last, and rows of its second dimension; only chunks that these touch are read."""
        d = self.variables[name]
        if d.dtype is None:
            raise Unsupported(f"{self.path}: {name} holds no numbers")
        shape = d.shape or [1]
        low, high = [0] * len(shape), list(shape)
        low[0], high[0] = first, shape[0] if last is None else min(last, shape[0])
        if rows and len(shape) > 1:
            low[1], high[1] = rows[0], min(rows[1], shape[1])
        inner = int(np.prod(shape[1:], dtype=np.int64)) * d.kind.size
        if d.layout[0] != "chunked":
            if d.layout[0] == "compact":
                raw = d.layout[1][low[0] * inner : high[0] * inner]
            elif d.layout[1] == _NOWHERE:
                raw = (d.fill or bytes(d.kind.size)) * ((high[0] - low[0]) * inner // d.kind.size)
            else:
                raw = self._at(d.layout[1] + low[0] * inner, (high[0] - low[0]) * inner)
            out = np.frombuffer(raw, d.dtype).reshape(high[0] - low[0], *shape[1:])
            return out[:, low[1] : high[1]] if rows and len(shape) > 1 else out
        out = np.empty([b - a for a, b in zip(low, high, strict=True)], d.dtype)
        out[...] = np.frombuffer(d.fill, d.dtype)[0] if d.fill else 0
        for c in self.chunks(name):
            ends = [min(a + n, s) for a, n, s in zip(c.at, d.chunk, shape, strict=True)]
            a, b = [max(x, y) for x, y in zip(c.at, low, strict=True)], [min(x, y) for x, y in zip(ends, high, strict=True)]
            if all(x < y for x, y in zip(a, b, strict=True)):
                inside = tuple(slice(x - o, y - o) for x, y, o in zip(a, b, c.at, strict=True))
                out[tuple(slice(x - o, y - o) for x, y, o in zip(a, b, low, strict=True))] = self._decoded(d, c)[inside]
        return out
