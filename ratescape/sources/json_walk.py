"""Cut large JSON documents into the elements of a few named arrays.

Helper of the readers for files that do not fit in one row. It only finds where
elements begin and end, with array arithmetic over blocks of bytes; fields are
parsed by ``from_json`` on the JVM side.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

BLOCK_BYTES = 4 << 20


def _key_before(buffer: bytes, low: int, at: int) -> str | None:
    """The key whose value begins at ``at``, found backwards over any number of blanks; None without one."""
    at = _last_not_blank(buffer, low, at)
    if at < low or buffer[at] != ord(":"):
        return None
    end = _last_not_blank(buffer, low, at)
    if end < low or buffer[end] != ord('"'):
        return None
    begin = buffer.rfind(b'"', low, end)
    while begin >= low and (begin - len(buffer[low:begin].rstrip(b"\\")) - low) % 2:  # an escaped quote
        begin = buffer.rfind(b'"', low, begin)
    return json.loads(buffer[begin : end + 1]) if begin >= low else None


def _last_not_blank(buffer: bytes, low: int, end: int) -> int:
    """Place of the last byte before ``end`` that is no white space, looked for in growing pieces."""
    step = 64
    while end > low:
        begin = max(low, end - step)
        kept = len(buffer[begin:end].rstrip(b" \t\r\n"))
        if kept:
            return begin + kept - 1
        end, step = begin, step * 2
    return low - 1


def open_stream(path: str):
    """Byte stream of a local or remote file, decompressed by its suffix."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        filesystem, inner = fs.FileSystem.from_uri(path)
    else:
        filesystem, inner = fs.LocalFileSystem(), path
    compression = "gzip" if inner.endswith(".gz") else None
    return filesystem.open_input_stream(inner, compression=compression)


class _Brackets:
    """Brackets outside strings, block by block: (offset, is_open, depth after)."""

    def __init__(self) -> None:
        self.depth = 0
        self.in_string = False
        self._escape = False

    def find(self, block: bytes, deepest: int) -> list[tuple[int, bool, int]]:
        """Brackets that open a level up to ``deepest`` or close one."""
        import numpy as np

        data = np.frombuffer(block, np.uint8)
        # '[' 91, ']' 93, '{' 123, '}' 125: the curly ones differ by bit 32 only.
        folded = data & 0b1101_1111
        marks = np.flatnonzero((data == ord('"')) | (folded == ord("[")) | (folded == ord("]")))
        kind = data[marks]
        quote = kind == ord('"')
        self._drop_escaped(np, block, data, marks, quote)
        parity = np.cumsum(quote) + self.in_string
        self.in_string = bool(len(parity) and parity[-1] % 2 or not len(parity) and self.in_string)
        outside = (kind != ord('"')) & (parity % 2 == 0)
        at, kind = marks[outside], kind[outside]
        opens = (kind == ord("[")) | (kind == ord("{"))
        depth = self.depth + np.cumsum(np.where(opens, 1, -1))
        if len(depth):
            self.depth = int(depth[-1])
        near = depth <= np.where(opens, deepest, deepest - 1)
        return list(zip(at[near].tolist(), opens[near].tolist(), depth[near].tolist(), strict=True))

    def _drop_escaped(self, np, block: bytes, data, marks, quote) -> None:
        """A quote after an odd run of backslashes does not end a string."""
        carried, self._escape = self._escape, False
        if b"\\" not in block:
            if carried and len(marks) and marks[0] == 0:
                quote[0] = False
            return
        slashes = np.flatnonzero(data == ord("\\"))
        breaks = np.flatnonzero(np.diff(slashes) != 1)
        first = slashes[np.concatenate(([0], breaks + 1))]
        after = slashes[np.concatenate((breaks, [len(slashes) - 1]))] + 1
        length = after - first
        if carried and first[0] == 0:
            length[0] -= 1
        escaped = after[length % 2 == 1]
        self._escape = bool(len(escaped) and escaped[-1] == len(data))
        if carried and first[0] != 0:
            escaped = np.concatenate(([0], escaped))
        quote[np.isin(marks, escaped, assume_unique=True)] = False


@dataclass
class _Object:
    """An object being read: its text without the elements of named arrays."""

    depth: int
    arrays: dict[str, dict | None]
    ord: int
    text: list[bytes] = field(default_factory=list)
    begin: int = 0
    code: str | None = None
    skip: bool = False

    def scalars(self, closing: bytes = b"") -> dict:
        parsed = json.loads(b"".join(self.text) + closing)
        return {k: v for k, v in parsed.items() if not isinstance(v, dict | list)}


@dataclass
class _Array:
    depth: int
    name: str
    elements: dict[str, dict | None] | None
    after: int
    count: int = 0
    leaf: int | None = None

    def pass_over(self, gap: bytes, opens: bool) -> None:
        """Count the elements that are no objects, in the text since the last one that is."""
        gap = gap.strip()
        if gap != (b"," if opens and self.count else b""):
            seen = self.count > 0
            read = json.loads((b"[0" if seen else b"[") + gap + (b"0]" if opens else b"]"))
            self.count += len(read) - seen - opens


# (event, array name, element number, owner, payload)
Event = tuple[str, str, int, _Object | None, object]


def walk(path: str, arrays: dict[str, dict | None], deepest: int) -> Iterator[Event]:
    """Events of a document, in order.

    ``arrays`` names the arrays to cut up; a nested mapping names arrays inside
    their elements. ``open`` tells that an array of ``owner`` begins and ``close`` how many elements it had, ``leaf``
    has an element's bytes, ``object`` the scalars of an element that itself
    has named arrays, and ``document`` the scalars of the whole, at its end.
    """
    with open_stream(path) as stream:
        brackets, buffer, offset = _Brackets(), b"", 0
        stack: list[_Object | _Array] = []
        done = False
        while block := stream.read(BLOCK_BYTES):
            start = offset + len(buffer)
            if start == 0 and block.startswith(b"\xef\xbb\xbf"):
                block = b"   " + block[3:]
            buffer += block
            for at, is_open, depth in brackets.find(block, deepest):
                at += start
                here = at - offset
                top = stack[-1] if stack else None
                if top is None:
                    if done or not is_open or buffer[here] != ord("{"):
                        raise ValueError("the document is not one JSON object")
                    stack.append(_Object(1, arrays, -1, begin=at))
                elif isinstance(top, _Object):
                    if is_open and depth == top.depth + 1 and buffer[here] == ord("["):
                        name = _key_before(buffer, max(0, top.begin - offset), here)
                        if name in top.arrays:
                            top.text.append(buffer[top.begin - offset : here + 1])
                            yield "open", name, -1, top, None
                            stack.append(_Array(depth, name, top.arrays[name], at + 1))
                    elif not is_open and depth == top.depth - 1:
                        top.text.append(buffer[top.begin - offset : here + 1])
                        stack.pop()
                        if stack:
                            stack[-1].after = at + 1
                            yield "object", stack[-1].name, top.ord, top, top.scalars()
                        else:
                            done = True
                            yield "document", "", -1, top, top.scalars()
                elif is_open:
                    if depth == top.depth + 1 and buffer[here] == ord("{"):
                        top.pass_over(buffer[top.after - offset : here], True)
                        if top.elements is None:
                            top.leaf = at
                        else:
                            stack.append(_Object(depth, top.elements, top.count, begin=at))
                            top.count += 1
                elif depth == top.depth - 1:
                    top.pass_over(buffer[top.after - offset : here], False)
                    stack.pop()
                    stack[-1].begin = at
                    yield "close", top.name, top.count, stack[-1], None
                elif depth == top.depth and top.leaf is not None:
                    owner = stack[-2]
                    if not owner.skip:
                        yield "leaf", top.name, top.count, owner, buffer[top.leaf - offset : here + 1]
                    top.count, top.leaf, top.after = top.count + 1, None, at + 1
            # Keep only what an unfinished piece still needs.
            top = stack[-1] if stack else None
            needed = offset + len(buffer)
            if isinstance(top, _Object):
                needed = top.begin
            elif top is not None:
                needed = top.after if top.leaf is None else top.leaf
            buffer, offset = buffer[needed - offset :], needed
        if not done:
            raise ValueError("the document ends too early")


Piece = tuple[str, int, int, str | None, str]
RATE_ARRAYS = {"in_network": {"negotiated_rates": None}, "provider_references": None}


def walk_rate_file(path: str, codes: str | frozenset[str]) -> Iterator[Piece]:
    """(kind, item_ord, ord, code, body) of every piece of a rate file.

    Scalars of the document and of each item are sent when it closes. Texts of
    rates and references are cut out, not parsed. Rates of
    an item whose code came first and is not in ``codes``, a set or a pattern, are left out.
    """
    wanted = re.compile(codes).fullmatch if isinstance(codes, str) else codes.__contains__
    for event, name, ord_, owner, payload in walk(path, RATE_ARRAYS, 5):
        if event == "open" and name == "negotiated_rates":
            code = owner.scalars(b"]}").get("billing_code")
            if code is not None:
                owner.code = str(code)
                owner.skip = not wanted(owner.code)
        elif event == "leaf" and name == "negotiated_rates":
            yield "rate", owner.ord, ord_, owner.code, payload.decode("utf-8")
        elif event == "leaf":
            yield "reference", -1, ord_, None, payload.decode("utf-8")
        elif event == "object":
            yield "item", ord_, -1, None, json.dumps(payload)
        elif event == "document":
            yield "header", -1, -1, None, json.dumps(payload)


def walk_codes(path: str) -> Iterator[str]:
    """Billing code of one item after the other, '' where it has none.

    The file is read only as far as the caller goes on.
    """
    for event, _, _, _, payload in walk(path, {"in_network": {}}, 3):
        if event == "object":
            yield str(payload.get("billing_code") or "")
