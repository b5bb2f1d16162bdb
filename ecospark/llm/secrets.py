"""Secret scans through nested encodings.

Every whole text is scanned for three kinds of secrets.  Its encoded parts (URL escapes, Unicode and character
escapes, base64 of text, base64 of compressed data) are unwrapped into layers, each of which is scanned and
unwrapped in turn until nothing new appears.  A worklist holds the open layers; a layer whose content was seen
before in the same document is not opened again, so that encodings which reproduce themselves end.  Each character
of a layer knows the characters of the document it came from; a secret in a layer is reported there.

Escapes map character by character; base64 and compressed data map to the whole encoded run, which may go on over
lines of one length and may begin after a prefix of the alphabet.  Bytes and escapes that are no character become
U+FFFD; decoded bytes without twelve printable ASCII characters in a row, too few for a secret, are not opened unless
all of them are text.  Broken members give what precedes the damage and count in ``n_unopened``.

``max_layer`` bounds the bytes of a layer in memory.  A compressed run that grows beyond it is read as a stream, in
windows cut where no secret and no encoded run can be, each a layer.  Time grows with the content.  Where a window has
no such place (one unbroken run of ``max_layer`` bytes) it is scanned in parts and the run counts in ``n_unopened``;
redaction replaces every run that counts there.

Edge cases: a null or empty text has no secrets.  Very long texts are one row each.  Equal rows get equal results;
equal spans of one kind are reported once.  An empty table gives an empty result.  Extra columns are left out.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import itertools
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, documents_of, slices

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNIT = (r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
         r"|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|&(amp|lt|gt|quot|apos);")
_ESCAPE = re.compile(_UNIT)
_ESCAPES = re.compile("(?:" + re.sub(r"\((?!\?)", "(?:", _UNIT) + ")+")
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_RUN = r"[A-Za-z0-9+/_-]"
#: Base64 over several lines, also with line ends written as escapes; lines may be indented.
_LINE_END = r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*"
_END = re.compile(_LINE_END)
_WRAPPED = re.compile(rf"(?<!{_RUN}){_RUN}{{4,}}(?:{_LINE_END}{_RUN}+)+={{0,2}}")
#: Characters after which base64 may begin in a run.
_BREAK = re.compile(r"[+/_-]")
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17\x72\x45\x38\x50\x90)|\x28\xb5\x2f\xfd")
#: The least that a secret, or an encoding of one, can be.
_PLAIN = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")
#: Bytes of a window at least, where its content allows it.
_WINDOW = 8 << 20
#: Where content may be cut: behind characters that are in no secret and no encoded run, between words, at line ends.
_CUT = re.compile(rb"[^A-Za-z0-9+/_=.%\\&#;{}:\"'\x20\t\r\n-]|(?<=[A-Za-z0-9])\x20(?=[A-Za-z0-9])"
                  rb"|(?<![A-Za-z0-9+/_=-]{4})(?<![A-Za-z0-9+/_=-]{3}\r)\n")
#: What stands for bytes and escapes that are no character.
_STRAY = "\ufffd"
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the secrets in one plain text."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return found


class Layer:
    """A text and where it came from: character i from [first[i], last[i]) of the document (ascending arrays), all of
    it from one place (two numbers), or the document itself (None)."""

    __slots__ = ("text", "first", "last")

    def __init__(self, text: str, first, last):
        self.text, self.first, self.last = text, first, last

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.first is None:
            return start, end
        if isinstance(self.first, int):
            return self.first, self.last
        return int(self.first[start]), int(self.last[end - 1])


def _text(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return None if _CONTROL.search(text) else text


def _wide(data: bytes) -> str | None:
    """UTF-16 text of which half or more is Latin; None for other data."""
    for zeros, codec in ((data[1::2], "utf-16-le"), (data[::2], "utf-16-be")):
        if len(zeros) >= 4 and 2 * zeros.count(0) >= len(zeros):
            text = data[:len(data) // 2 * 2].decode(codec, "replace").lstrip("\ufeff")
            if not _CONTROL.search(text):
                return text
    return None


def _url(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of URL escapes with their places in it; a stray byte is one character."""
    out, at = [], 0
    for ch in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        stray = 0xDC80 <= ord(ch) <= 0xDCFF
        out.append((_STRAY if stray else ch, at, at := at + 3 * (1 if stray else len(ch.encode()))))
    return out


def _escape(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of character escapes with their places in it; surrogate pairs are one character, and so is
    an escape that stands for none."""
    out, high = [], None
    for m in _ESCAPE.finditer(run):
        start, digits = m.start(), m[1] or m[2] or m[3] or m[4] or m[6]
        code = int(digits, 16) if digits else int(m[5]) if m[5] else ord(_NAMED[m[7]])
        if high and 0xDC00 <= code < 0xE000:
            code, start, high = 0x10000 + (high[0] - 0xD800 << 10) + code - 0xDC00, high[1], None
        elif high:
            out.append((_STRAY, high[1], start))
            high = None
        if 0xD800 <= code < 0xDC00:
            high = code, start
        else:
            out.append((_STRAY if code > 0x10FFFF or 0xDC00 <= code < 0xE000 else chr(code), start, m.end()))
    return out + ([(_STRAY, high[1], len(run))] if high else [])


#: An escape that was escaped again and again: the first character and the unit that repeats.
_CHAIN = re.compile(r"%(?:25){2,}|&(?:amp;){2,}|\\(?:u005[Cc]){2,}|\\(?:x5[Cc]){2,}")


def _chain(run: str) -> list[tuple[str, int, int]]:
    """A chain with one unit left.  What the layers between would show of it is a shorter part of it."""
    cut = len(run) - {"%": 2, "&": 4}.get(run[0], 5 if run[1] == "u" else 3)
    return [(run[0], 0, cut), *((run[k], k, k + 1) for k in range(cut, len(run)))]


def _unescaped(layer: Layer, runs: re.Pattern, decode) -> Layer | None:
    """The layer with every decodable run of escapes replaced; None if there is none."""
    parts, first, last, at = [], [], [], 0
    for m in runs.finditer(layer.text):
        chars = decode(m[0])
        if chars:
            parts += [layer.text[at:m.start()], "".join([c for c, _, _ in chars])]
            first += [np.arange(at, m.start()), np.array([a for _, a, _ in chars]) + m.start()]
            last += [np.arange(at, m.start()), np.array([b for _, _, b in chars]) + m.start() - 1]
            at = m.end()
    if not parts:
        return None
    rest = np.arange(at, len(layer.text))
    text = "".join(parts) + layer.text[at:]
    if isinstance(layer.first, int):
        return Layer(text, layer.first, layer.last)
    first, last = np.concatenate([*first, rest]), np.concatenate([*last, rest])
    return Layer(text, first, last + 1) if layer.first is None else Layer(text, layer.first[first], layer.last[last])


class _TooLong(Exception):
    """Data, with the places where zlib may start, whose content is beyond the bound."""


#: Bytes of input for a zstd decoder at a time: its output has no bound of its own (128 KB for four bytes at most).
_FEED = 1024
_DAMAGED = (zlib.error, OSError, ValueError, EOFError, zstandard.ZstdError)


def _decoder(head: bytes):
    """A decoder for compressed data (gzip, zlib, bzip2, zstd) that begins so, None if it is none."""
    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] & 0x0F == 8 and head[0] < 0x80 and (head[0] << 8 | head[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _pieces(one, data: bytes, size: int):
    """What a decoder gives for ``data``, in pieces of about ``size``."""
    if isinstance(one, bz2.BZ2Decompressor):
        yield one.decompress(data, size)
        while not one.eof and not one.needs_input:
            yield one.decompress(b"", size)
    elif hasattr(one, "unconsumed_tail"):
        yield (out := one.decompress(data, size))
        while not one.eof and (one.unconsumed_tail or len(out) == size):  # a full piece may leave output in the decoder
            yield (out := one.decompress(one.unconsumed_tail, size))
    else:
        at = 0
        while at < len(data) and not one.eof:
            yield one.decompress(data[at:at + _FEED])
            at += _FEED
        one.after = data[at:] if one.eof else b""


class _Feed:
    """One zstd frame: a decoder with what follows the frame."""

    def __init__(self, one):
        self.one, self.after = one, b""

    @property
    def eof(self):
        return self.one.eof

    @property
    def unused_data(self):
        return self.one.unused_data + self.after

    def decompress(self, data):
        return self.one.decompress(data)


def inflated(chunks, size: int = 1 << 20, left: list | None = None):
    """The content of all members of compressed chunks in pieces; what follows the last member comes as it is, or
    the number of its bytes at hand goes to ``left``.  Damaged data is an error, as is data that ends inside a member (EOFError, after the pieces before it)."""
    chunks, rest = iter(chunks), b""
    while True:
        while len(rest) < 4 and (more := next(chunks, b"")):
            rest = bytes(rest) + bytes(more)
        one = _decoder(rest)
        if one is None:
            if left is not None:
                left.append(len(rest))
            elif rest:
                yield rest
                yield from chunks
            return
        one = _Feed(one) if rest[:4] == b"\x28\xb5\x2f\xfd" else one
        while True:
            yield from filter(None, _pieces(one, rest, size))
            if one.eof:
                rest = one.unused_data
                break
            if not (rest := next(chunks, b"")):
                raise EOFError


class _Chunks:
    """``data`` from ``at`` on in chunks; ``fed`` is the place behind the last one."""

    def __init__(self, data: bytes, at: int):
        self.data, self.fed = memoryview(data), at

    def __iter__(self):
        while self.fed < len(self.data):
            start, self.fed = self.fed, min(self.fed + (1 << 16), len(self.data))
            yield self.data[start:self.fed]


def _member(data: bytes, at: int, most: int) -> tuple[bytes, int, bool] | None:
    """The content of the members from ``at`` on, the place behind them, and whether they are whole; None if there
    are none."""
    if _decoder(data[at:at + 4]) is None:
        return None
    out, size, left, chunks = [], 0, [], _Chunks(data, at)
    try:
        for piece in inflated(chunks, min(most + 1, 1 << 20), left):
            out.append(piece)
            if (size := size + len(piece)) > most:
                raise _TooLong(data, [at])
        return b"".join(out), chunks.fed - left[0], True
    except _DAMAGED as e:
        # two bytes of any data look like zlib now and then: only what gives text is taken for a broken member
        content, end = b"".join(out), len(data) if isinstance(e, EOFError) else at
        return (content, end, False) if _MAGIC.match(data, at) or _PLAIN.search(content) else None


def unpacked(data: bytes, starts: list[int], most: int) -> tuple[bytes, int, int]:
    """``data`` with its compressed members replaced by their content, again and again; the number of replaced
    members, and of broken ones.  zlib, of which two bytes are all that mark it, is tried at ``starts``."""
    done = broken = 0
    while True:
        parts, end, last, found = [], 0, 0, 0
        for at in sorted({m.start() for m in _MAGIC.finditer(data)}.union(starts)):
            try:
                member = _member(data, at, most) if at >= end else None
            except _TooLong:
                raise _TooLong(data, starts) from None
            if member:
                content, end, whole = member
                parts += [data[last:at], content]
                last, found, broken = end, found + 1, broken + (not whole)
        if not found:
            return data, done, broken
        inner = b"".join([*parts, data[last:]])
        if len(inner) > most:
            raise _TooLong(data, starts)
        if inner == data:
            return data, done, broken
        data, starts, done = inner, [0], done + found


def _deeper(pieces):
    """The pieces of a stream, inflated as long as its beginning is compressed."""
    heads = set()
    while True:
        head = b""
        for piece in pieces:
            head += piece
            if len(head) >= 4:
                break
        pieces = itertools.chain([head], pieces)
        try:
            one = _decoder(head)
            if one is None or head in heads:
                return pieces
            next(filter(None, inflated([head])), b"")
        except EOFError:
            pass
        except _DAMAGED:
            return pieces
        heads.add(head)
        pieces = inflated(pieces)


def _stream(data: bytes, starts: list[int], lost: list):
    """``data`` with its members replaced by their content, in pieces; ``lost`` gets an entry for a broken member."""
    last = end = 0
    for at in sorted({m.start() for m in _MAGIC.finditer(data)}.union(starts)):
        if at < end or _decoder(data[at:at + 4]) is None:
            continue
        left, chunks, given = [], _Chunks(data, at), False
        try:
            for piece in _deeper(inflated(chunks, left=left)):
                if not given:
                    yield data[last:at]
                given, last = True, at
                yield piece
        except _DAMAGED:
            if given or _MAGIC.match(data, at):
                lost.append(at)
            continue
        if left:
            last = end = chunks.fed - left[0]
    yield data[last:]


def _windows(pieces, most: int, lost: list):
    """A stream cut where no secret and no encoded run can be; ``lost`` gets an entry where there is no such place
    in ``most`` bytes."""
    held, known, step = bytearray(), 0, min(most, 1 << 20)
    for piece in (x[k:k + step] for x in pieces for k in range(0, len(x), step)):
        held += piece
        while len(held) >= min(most, _WINDOW):
            cut, stop = 0, len(held) - 1
            while not cut and stop > known:
                start = max(known, stop - (1 << 16))
                cut = max((m.end() for m in _CUT.finditer(held, start, stop)), default=0)
                stop = start
            if not cut and len(held) < most:
                known = max(0, len(held) - 32)
                break
            if not cut:
                lost.append(len(held))
            yield bytes(held[:cut or len(held)])
            del held[:cut or max(1, len(held) - min(most // 2, 4096))]
            known = 0
    if held:
        yield bytes(held)


def windows(data: bytes, starts: list[int], most: int, lost: list):
    """The content of data that is beyond ``most``, in windows that hold no more than that at a time."""
    for window in _windows(_stream(data, starts, lost), most, lost):
        try:
            inner, _, broken = unpacked(window, [], most)
        except _TooLong as e:
            yield from windows(*e.args, most, lost)
        else:
            lost += [0] * broken
            yield inner


def _encoded(text: str):
    """(start, end, run, places in it where base64 may begin) of the base64 runs, then of the blocks of lines."""
    for m in _BASE64.finditer(text):
        run = m[0].rstrip("=")
        yield m.start(), m.end(), run, [0, *(x.end() for x in _BREAK.finditer(run))]
    for m in _WRAPPED.finditer(text):
        cuts = [(x.start() + m.start(), x.end() + m.start()) for x in _END.finditer(m[0])]
        first, last = [m.start(), *(b for _, b in cuts)], [*(a for a, _ in cuts), m.end()]
        lines = [text[a:b].rstrip("=") for a, b in zip(first, last)]
        size, k = [len(x) for x in lines], 0
        while k < len(lines):
            n = k + 1
            while n < len(lines) and size[n] == size[k]:
                n += 1
            stop = n + (n < len(lines) and size[n] < size[k])  # a shorter line ends the block
            # the first line may stand behind other text
            for start in {k, k - (k == 1)} if size[k] >= 16 else ():
                if stop - start > 1:
                    run, at = "".join(lines[start:stop]), np.cumsum([0, *size[start:stop - 1]]).tolist()
                    yield first[start], last[stop - 1], run, [*at, *(x.end() for x in _BREAK.finditer(run))]
            k = n


def _base64_layers(layer: Layer, most: int, show) -> tuple[list[Layer], list[tuple[int, int]]]:
    """Layers of the base64 runs that hold text or compressed text, and the places of the runs that could not be read
    to their end.  Content beyond ``most`` is given to ``show`` window by window.

    A run may begin before its base64 does (a path, a key's name), so it is read from its first four characters, and
    compressed data is looked for everywhere in it."""
    found, whole, failed = [], [], []
    for start, end, run, starts in _encoded(layer.text):
        body, ok, lost, place = run.translate(_STANDARD), False, [], layer.place(start, end)
        for k in range(4):
            piece = body[k:] if len(body[k:]) % 4 != 1 else body[k:-1]
            data = binascii.a2b_base64(piece + "=" * (-len(piece) % 4))
            try:
                data, members, broken = unpacked(data, [(x - k) // 4 * 3 for x in starts if x % 4 == k], most)
            except _TooLong as e:
                before = len(lost)
                for window in windows(*e.args, most, lost):
                    if _PLAIN.search(window):
                        show(Layer(window.decode("utf-8", "replace"), *place))
                ok = ok or len(lost) == before
                continue
            ok = ok or members > broken
            lost += [0] * broken
            text = _text(data) if k == 0 or members else None
            if text is None:
                text = _wide(data)
            if text is None and _PLAIN.search(data):
                text = data.decode("utf-8", "replace")
            if text:
                found.append(Layer(text, *place))
        (failed if lost else whole if ok else []).append((start, end))
    # a line of a block that is whole is no broken run, nor is a block's line besides the broken block
    return found, [layer.place(x, y) for x, y in failed if not any(a <= x and y <= b and (a, b) != (x, y) for a, b in whole + failed)]


_STANDARD = str.maketrans("-_", "+/")


def _scanned(text: str, max_layer: int) -> tuple[list, list, int, list]:
    """Base spans, all spans, opened layers, and the places of runs that could not be read to their end."""
    base = find(text)
    every = {(s, k, e) for s, e, k in base}
    seen, opened, unopened = set(), 0, []

    def drain(work):
        nonlocal opened, unopened
        while work:
            layer = work.popleft()
            if layer.first is not None:
                every.update((a, k, b) for s, e, k in find(layer.text) for a, b in [layer.place(s, e)])
            inner = []
            if _CHAIN.search(layer.text):  # all its layers in one pass
                inner.append(_unescaped(layer, _CHAIN, _chain))
            else:
                if "%" in layer.text:
                    inner.append(_unescaped(layer, _URL, _url))
                if "\\" in layer.text or "&" in layer.text:
                    inner.append(_unescaped(layer, _ESCAPES, _escape))

            def fresh(new):
                nonlocal opened
                # the same content of another place of the document is another layer, not a cycle
                key = hashlib.blake2b(new.text.encode("utf-8", "replace"), digest_size=16).digest(), new.place(0, len(new.text))
                if new.text == layer.text or key in seen:
                    return False
                seen.add(key)
                opened += 1
                return True
            # a window is drained before the next one is made
            runs, places = _base64_layers(layer, max_layer, lambda new: fresh(new) and drain(deque([new])))
            unopened += places
            work.extend(new for new in [x for x in inner if x] + runs if fresh(new))
    drain(deque([Layer(text, None, None)]))
    return sorted((s, k, e) for s, e, k in base), sorted(every), opened, unopened


def scan(text: str, max_layer: int = 64 << 20) -> tuple[list, list, int, int]:
    """Base spans, all spans, opened layers and unopened runs of a text; spans are (start, kind, end), sorted."""
    base, every, opened, unopened = _scanned(text, max_layer)
    return base, every, opened, len(unopened)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame, max_layer: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, counts and digest of the base spans, all spans, n_added, n_layers, n_unopened."""
    def per_batch(batch):
        for part in slices(batch, "text"):
            rows = [scan(t, max_layer) for t in part.column("text").to_pylist()]
            counts = [[sum(x[1] == k for x in r[0]) for r in rows] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(listed(r[0]).encode()).hexdigest() for r in rows]), pa.array([listed(r[1]) for r in rows]),
                 pa.array([len(r[1]) - len(set(r[0])) for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.int64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added", "n_layers", "n_unopened"])
    return arrow_map(documents_of(docs, id_col, text_col), per_batch, "doc_id long, n_assign long, n_access long, n_hex long, "
                     "base_sha256 string, spans string, n_added long, n_layers long, n_unopened long")


def redacted(text: str | None, mark: str = "[SECRET]", max_layer: int = 64 << 20) -> str | None:
    """The text with every secret's place replaced by ``mark``, and every run's that could not be read to its end;
    overlapping places are one."""
    if not text:
        return text
    out, at = [], 0
    _, every, _, unopened = _scanned(text, max_layer)
    for start, end in sorted({(a, b) for a, _, b in every}.union(unopened)):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with secrets in ``text_col`` replaced; other columns, null texts and the order of columns stay."""
    place = docs.columns.index(text_col)

    def per_batch(batch):
        texts = [redacted(t, mark) for t in batch.column(place).to_pylist()]
        yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
    return arrow_map(docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")), per_batch, docs.schema)
