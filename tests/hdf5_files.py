"""Small HDF5-based files, written byte by byte from the format's published description: both kinds of groups and headers."""

import struct
import zlib

import numpy as np

NOWHERE = 2**64 - 1


class Writer:
    """new: superblock 2, headers 2 and links; otherwise superblock 0, headers 1 and symbol tables."""

    def __init__(self, new, dense=0):
        self.new, self.dense, self.raw, self.names = new, dense, bytearray(48 if new else 96), {}

    def put(self, data):
        self.raw += bytes(-len(self.raw) % 8)
        self.raw += data
        return len(self.raw) - len(data)

    @staticmethod
    def pad(b):
        return b + bytes(-len(b) % 8)

    @staticmethod
    def kind(dtype):
        """A datatype message."""
        d = np.dtype(dtype)
        big = d.byteorder == ">"
        if d.kind == "f":
            bits, rest = (0x20 | big, 31 if d.itemsize == 4 else 63), {4: (0, 32, 23, 8, 0, 23, 127), 8: (0, 64, 52, 11, 0, 52, 1023)}[d.itemsize]
            return struct.pack("<BBBBI", 0x11, bits[0], bits[1], 0, d.itemsize) + struct.pack("<HHBBBBI", *rest)
        if d.kind == "S":
            return struct.pack("<BBBBI", 0x13, 0, 0, 0, d.itemsize)
        return struct.pack("<BBBBI", 0x10, big | (8 if d.kind == "i" else 0), 0, 0, d.itemsize) + struct.pack("<HH", 0, 8 * d.itemsize)

    @staticmethod
    def space(shape):
        return struct.pack("<BBB5x", 1, len(shape), 0) + struct.pack(f"<{len(shape)}Q", *shape)

    def attribute(self, name, value):
        if isinstance(value, list):  # names of dimensions: references in a heap
            items = [struct.pack("<Q", self.names[n]) for n in value]
            body = b"".join(struct.pack("<HH4xQ", k + 1, 1, 8) + x for k, x in enumerate(items)) + bytes(16)
            heap = self.put(b"GCOL" + struct.pack("<B3xQ", 1, 16 + len(body)) + body)
            kind = struct.pack("<BBBBI", 0x19, 0, 0, 0, 16) + struct.pack("<BBBBI", 0x17, 0, 0, 0, 8)
            space, data = self.space([len(items)]), b"".join(struct.pack("<IQI", 1, heap, k + 1) for k in range(len(items)))
        elif isinstance(value, str):
            data = value.encode() + b"\0"
            kind, space = self.kind(f"S{len(data)}"), self.space([])
        else:
            value = np.atleast_1d(value)
            data, kind, space = value.tobytes(), self.kind(value.dtype), self.space(value.shape)
        named = name.encode() + b"\0"
        if self.new:
            return struct.pack("<BBHHHB", 3, 0, len(named), len(kind), len(space), 0) + named + kind + space + data
        return struct.pack("<BBHHH", 1, 0, len(named), len(kind), len(space)) + self.pad(named) + self.pad(kind) + self.pad(space) + data

    def header(self, messages):
        """An object header; the last message goes into a continuation."""
        *first, last = messages
        if self.new:
            make = lambda k, b: struct.pack("<BHB", k, len(b), 0) + b
            more = b"OCHK" + make(*last) + bytes(4)
            body = b"".join(make(*m) for m in first) + make(16, struct.pack("<QQ", self.put(more), len(more)))
            return self.put(b"OHDR" + struct.pack("<BBIIIII", 2, 0x22, 1, 2, 3, 4, len(body)) + body + bytes(4))
        make = lambda k, b: struct.pack("<HHB3x", k, len(self.pad(b)), 0) + self.pad(b)
        more = make(*last)
        body = b"".join(make(*m) for m in first) + make(16, struct.pack("<QQ", self.put(more), len(more)))
        return self.put(struct.pack("<BxHII4x", 1, len(messages) + 1, 1, len(body)) + body)

    def dataset(self, name, data, attrs, chunk=None, deflate=True, shuffle=True, checksum=False, absent=()):
        messages = [(1, self.space(data.shape)), (3, self.kind(data.dtype))]
        if chunk:
            entries = []
            for at in np.ndindex(*[-(-n // c) for n, c in zip(data.shape, chunk, strict=True)]):
                if at in absent:
                    continue
                at = [k * c for k, c in zip(at, chunk, strict=True)]
                whole = np.zeros(chunk, data.dtype)
                part = data[tuple(slice(a, a + c) for a, c in zip(at, chunk, strict=True))]
                whole[tuple(slice(0, n) for n in part.shape)] = part
                raw, mask = whole.tobytes(), 0
                if shuffle:
                    raw = np.frombuffer(raw, np.uint8).reshape(-1, data.itemsize).T.tobytes()
                packed = zlib.compress(raw) if deflate else raw
                if deflate and len(entries) == 1:  # one chunk that the filter was skipped for
                    packed, mask = raw, 1 << int(shuffle)
                entries.append((struct.pack("<II", len(packed) + 4 * checksum, mask) + struct.pack(f"<{len(at) + 1}Q", *at, 0), self.put(packed + bytes(4 * checksum))))
            half = len(entries) // 2
            leaves = [self.put(self.tree(1, 0, part)) for part in (entries[:half], entries[half:]) if part]
            firsts = [part[0][0] for part in (entries[:half], entries[half:]) if part]
            root = self.put(self.tree(1, 1, list(zip(firsts, leaves, strict=True)))) if entries else NOWHERE
            filters = [(2, [data.itemsize])] * shuffle + [(1, [4])] * deflate + [(3, [])] * checksum
            messages.append((8, struct.pack("<BBBQ", 3, 2, len(chunk) + 1, root) + struct.pack(f"<{len(chunk) + 1}I", *chunk, data.itemsize)))
            if self.new:
                pipe = b"".join(struct.pack("<HHH", k, 0, len(v)) + struct.pack(f"<{len(v)}I", *v) for k, v in filters)
                messages.append((11, struct.pack("<BB", 2, len(filters)) + pipe))
            else:
                pipe = b"".join(struct.pack("<HHHH", k, 8, 0, len(v)) + b"filter\0\0" + struct.pack(f"<{len(v)}I", *v) + bytes(4 * (len(v) % 2)) for k, v in filters)
                messages.append((11, struct.pack("<BB6x", 1, len(filters)) + pipe))
            messages.append((5, struct.pack("<BB", 3, 0x20) + struct.pack("<I", data.itemsize) + np.array(-99, data.dtype).tobytes() if self.new else struct.pack("<BBBBI", 2, 2, 0, 1, data.itemsize) + np.array(-99, data.dtype).tobytes()))
        else:
            messages.append((8, struct.pack("<BBQQ", 3, 1, self.put(data.tobytes()), data.nbytes)))
        own = [self.attribute(k, v) for k, v in attrs.items()]
        if self.new and len(own) > (self.dense or 10**9):
            messages.append((21, struct.pack("<BBQQ", 0, 0, *self.heap(own, 8))))
            own = []
        messages += [(12, a) for a in own]
        self.names[name] = self.header(messages)

    def heap(self, items, kind, small=64):
        """Messages in a fractal heap of small blocks (two in each row), and a version 2 tree of names over them: (heap, tree)."""
        first, most, width = small, 1 << 16, 2
        blocks, places, head = [], [], 5 + 8 + 4  # a block: offset, length, data, row; its head has an offset of 32 bits
        slots = ((sum(width * (first << max(0, r - 1)) for r in range(row)) + k * (first << max(0, row - 1)), first << max(0, row - 1), row) for row in range(12) for k in range(width))
        for x in items:
            while not blocks or head + len(blocks[-1][2]) + len(x) > blocks[-1][1]:
                offset, length, row = next(slots)
                if head + len(x) <= length:
                    blocks.append([offset, length, b"", row])
            places.append((blocks[-1][0] + head + len(blocks[-1][2]), len(x)))
            blocks[-1][2] += x
        row = blocks[-1][3]
        rows = row + 1
        header = self.put(bytes(142))
        table = [NOWHERE] * (rows * width)
        for offset, length, data, r in blocks:
            before = sum(width * (first << max(0, k - 1)) for k in range(r))
            table[r * width + (offset - before) // length] = self.put((b"FHDB" + struct.pack("<BQI", 0, header, offset) + data).ljust(length, b"\0"))
        root = self.put(b"FHIB" + struct.pack("<BQI", 0, header, 0) + struct.pack(f"<{len(table)}Q", *table) + bytes(4))
        self.raw[header : header + 142] = b"FRHP" + struct.pack("<BHHBIQQQQQQQQQQQQ", 0, 7 if kind == 5 else 8, 0, 0, 4096, 0, NOWHERE, 0, NOWHERE, 0, 0, 0, len(items), 0, 0, 0, 0) + struct.pack("<HQQHHQH", width, first, most, 32, 1, root, rows)
        ids = [bytes([0]) + struct.pack("<I", o) + n.to_bytes(2, "little") for o, n in places]
        records = [struct.pack("<I", k) + i if kind == 5 else i.ljust(8, b"\0") + struct.pack("<BII", 0, k, k) for k, i in enumerate(ids)]
        size, node = len(records[0]), 256
        room = (node - 10) // size
        make = lambda name, body: self.put((name + struct.pack("<BB", 0, kind) + body).ljust(node, b"\0"))
        if len(records) <= room:
            depth, top, n = 0, make(b"BTLF", b"".join(records)), len(records)
        else:  # leaves, and between them a record each in the node above
            own, pointers, k = [], b"", 0
            while k < len(records):
                leaf = records[k : k + room - 1]
                pointers += struct.pack("<QB", make(b"BTLF", b"".join(leaf)), len(leaf))
                k += len(leaf)
                if k < len(records):
                    own.append(records[k])
                    k += 1
                    if k == len(records):
                        pointers += struct.pack("<QB", make(b"BTLF", b""), 0)
            depth, top, n = 1, make(b"BTIN", b"".join(own) + pointers), len(own)
        tree = self.put(b"BTHD" + struct.pack("<BBIHHBBQHQI", 0, kind, node, size, depth, 100, 40, top, n, len(records), 0))
        return header, tree

    @staticmethod
    def tree(kind, level, entries):
        body = b"".join(key + struct.pack("<Q", at) for key, at in entries)
        return b"TREE" + struct.pack("<BBHQQ", kind, level, len(entries), NOWHERE, NOWHERE) + body + bytes(len(entries[-1][0]))

    def close(self, path):
        names = sorted(self.names)
        if self.new:
            links = [(6, struct.pack("<BBB", 1, 0, len(n)) + n.encode() + struct.pack("<Q", self.names[n])) for n in names]
            where = (NOWHERE, NOWHERE)
            if len(links) > (self.dense or 10**9):
                where, links = self.heap([b for _, b in links], 5), [(0, bytes(4))]
            root = self.header([(2, struct.pack("<BBQQ", 0, 0, *where)), *links])
            self.raw[:48] = b"\x89HDF\r\n\x1a\n" + struct.pack("<BBBBQQQQI", 2, 8, 8, 0, 0, NOWHERE, len(self.raw), root, 0)
        else:
            text, at = bytearray(8), {}
            for n in names:
                at[n] = len(text)
                text += self.pad(n.encode() + b"\0")
            data = self.put(bytes(text))
            heap = self.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(text), NOWHERE, data))
            node = self.put(b"SNOD" + struct.pack("<BxH", 1, len(names)) + b"".join(struct.pack("<QQI4x16x", at[n], self.names[n], 0) for n in names))
            tree = self.put(self.tree(0, 0, [(struct.pack("<Q", 0), node)]))
            root = self.header([(17, struct.pack("<QQ", tree, heap)), (0, bytes(8))])
            self.raw[:96] = b"\x89HDF\r\n\x1a\n" + struct.pack("<BBBxBBBxHHI", 0, 0, 0, 0, 8, 8, 4, 16, 0) + struct.pack("<QQQQ", 0, NOWHERE, len(self.raw), NOWHERE) + struct.pack("<QQI4x16x", 0, root, 0)
        path.write_bytes(bytes(self.raw))


def write(path, times, lat, lon, cube, units=None, name="fwi", names=("time", "lat", "lon"), new=True, chunk=None, attrs=None, dense=0, **how):
    """A file as netCDF-4 has them: three axes that are dimension scales, and a variable on them."""
    w = Writer(new, dense)
    for n, axis, more in ((names[0], np.array(times, "<i4"), {"units": units} if units else {}), (names[1], np.array(lat, "<f8"), {}), (names[2], np.array(lon, "<f4"), {})):
        w.dataset(n, axis, {"CLASS": "DIMENSION_SCALE", "NAME": n, **more})
    w.dataset(name, cube, {"DIMENSION_LIST": list(names), **(attrs or {})}, chunk, **how)
    w.close(path)
