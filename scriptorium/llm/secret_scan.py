"""Secret scan with a recursive decoding worklist.

Every text is a layer. Scanning a layer yields spans by kind; unwrapping it
yields more layers: the layer with URL and Unicode escapes resolved, and one for
each base64 run, wrapped over lines or not, and for compressed bytes in such runs or in
escapes, unpacked to their end. Of bytes, what is ASCII
is read, and what is so in UTF-16 where they hold a zero. Layers are worked off until none is new. A layer remembers which characters of its parent each of its
characters stands for, so every span is reported in the whole text's own
code points.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm.common import table

#: Kinds in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of [0-9a-f]+ that is long enough is the same match as with {24,}: both take the whole run.
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
#: Characters of unpacked text held at once; a window ends where no span and no run can be open.
WINDOW = 8_000_000
#: Bytes unpacked or read at once, characters that windows share where they are cut within a stretch, and spaces in a row that are kept there.
PART, OVERLAP, SPACES = 1_000_000, 65_536, 64
#: Characters or bytes at the head of an archive that must unpack without fault.
HEAD = 2048
#: Archives within each other that are unpacked, as some unpack to themselves.
NESTED = 64

_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|\\U000[0-9A-Fa-f]{5}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]*")
_SIGN = re.compile(r"[+/_-]")
#: Base64 runs that follow each other over lines, or over line ends written as in JSON; the last may be short.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+)+[A-Za-z0-9+/_-]++={0,2}")
_LINE = re.compile(r"(?:\\r)?\\n|[A-Za-z0-9+/_=-]+")
#: Bytes written as escapes, with those that need none between them.
_BYTES = re.compile(r"(?:(?:%|\\x)[0-9A-Fa-f]{2}|[A-Za-z0-9_.~-]){8,}")
_BYTE = re.compile(r"(?:%|\\x)([0-9A-Fa-f]{2})")
_PLAIN = re.compile(r"[\t-\r -~]{12,}")
_SPACES = re.compile(" {%d,}" % SPACES)
#: Characters that are in no span, escape or run.
_APART = re.compile(r"[^A-Za-z0-9+/_.=\-\"':%\\&#;{}\s~]")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the plain patterns, leftmost and non-overlapping within a kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN] if "=" in text or ":" in text else []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _resolved(run: str) -> list[tuple[str, int]] | None:
    """The characters that an escape run stands for, each with the length it takes up; None if it stands for none."""
    if run[0] == "%":
        raw, out, i = bytes.fromhex(run.replace("%", "")), [], 0
        while i < len(raw):
            size = 1 if raw[i] < 0xC0 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
            try:
                out.append((raw[i : i + size].decode(), 3 * size))
            except UnicodeDecodeError:
                size = 1
                out.append((chr(raw[i]), 3))
            i += size
        return out
    if run[:2] == "\\u" and run[2] != "{":
        units = [int(run[i + 2 : i + 6], 16) for i in range(0, len(run), 6)]
        out, i = [], 0
        while i < len(units):
            if 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000:
                out.append((chr(0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00), 12))
                i += 2
            else:
                out.append((chr(units[i]) if not 0xD800 <= units[i] < 0xE000 else "�", 6))
                i += 1
        return out
    digits = re.sub(r"[^0-9A-Fa-f]", "", run[2:])
    code = int(digits, 10 if run[0] == "&" and run[2] not in "xX" else 16)
    return [(chr(code), len(run))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


class Layer:
    """A text and where its pieces stand in the whole text: piece k begins at
    ``at[k]`` here and at ``src[k]`` there; ``whole[k]`` is None for a piece copied
    character by character, else the end there of what it stands for."""

    def __init__(self, text: str, at: list[int], src: list[int], whole: list[int | None]):
        self.text, self.at, self.src, self.whole = text, at, src, whole

    def outer(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        first = self.src[i] if self.whole[i] is not None else self.src[i] + start - self.at[i]
        last = self.whole[j] if self.whole[j] is not None else self.src[j] + end - self.at[j]
        return first, last

    def unescaped(self) -> Layer | None:
        """This layer with its escapes resolved; None if it has none."""
        pieces, at, src, whole, n, done = [], [], [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal n
            for k in range(bisect_right(self.at, a) - 1, bisect_right(self.at, b - 1)) if b > a else ():
                lo = max(a, self.at[k])
                hi = min(b, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                at.append(n)
                src.append(self.src[k] if self.whole[k] is not None else self.src[k] + lo - self.at[k])
                whole.append(self.whole[k])
                pieces.append(self.text[lo:hi])
                n += hi - lo

        for m in _ESCAPE.finditer(self.text):
            found = _resolved(m[0])
            if found is None:
                continue
            copy(done, m.start())
            here = m.start()
            for char, size in found:
                first, last = self.outer(here, here + size)
                at.append(n)
                src.append(first)
                whole.append(last)
                pieces.append(char)
                n += 1
                here += size
            done = m.end()
        if not done:
            return None
        copy(done, len(self.text))
        return Layer("".join(pieces), at, src, whole)


_PACKED = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"x", lambda: zlib.decompressobj(15)),
    (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ", lzma.LZMADecompressor),
)

_MAGIC = tuple(magic for magic, _ in _PACKED)


def _is_packed(raw: bytes) -> bool:
    """Whether bytes begin as packed ones do, of which the first few can be taken."""
    for magic, make in _PACKED:
        if raw.startswith(magic):
            try:
                make().decompress(raw[:HEAD], PART)
                return True
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                return False
    return False


class Unpacking:
    """What bytes hold, as windows of text, through archives within archives.

    Bytes are pushed in as they come; ``feed`` and ``close`` give the windows that are complete. Members of an archive follow each
    other, and bytes after the last are taken as they are. Bytes that only look packed are taken as they are; of broken ones,
    what could be unpacked.
    """

    def __init__(self, depth: int = 0, archive: bool = False):
        self.depth, self.archive, self.state, self.head = depth, archive, "head", b""
        self.inner: Unpacking | Reading | None = None

    def feed(self, raw: bytes) -> Iterator[str]:
        while raw:
            if self.state == "lost":
                return
            if self.state == "member":
                raw = yield from self._member(raw)
                continue
            if self.state in ("head", "between"):
                self.head += raw
                if len(self.head) < 64:
                    return
                raw = self._begun()
                continue
            yield from self.inner.feed(raw)
            return

    def close(self) -> Iterator[str]:
        if self.state in ("head", "between") and self.head:
            rest = self._begun()
            while rest and self.state == "member":
                rest = yield from self._member(rest)
                if self.state == "between":
                    self.head, rest = rest, b""
                    if self.head:
                        rest = self._begun()
            if rest and self.state == "plain":
                yield from self.inner.feed(rest)
        if self.state == "member" and self.fresh and not self.archive:
            for raw in self.taken:
                yield from self.inner.feed(raw)
        if self.inner is not None:
            yield from self.inner.close()

    def _begun(self) -> bytes:
        """Chooses how the bytes held are read, and gives them back."""
        raw, self.head = self.head, b""
        packed = self.depth < NESTED and (_is_packed(raw) if self.state == "head" else raw.startswith(_MAGIC))
        if self.inner is None:
            self.inner = Unpacking(self.depth + 1) if packed else Reading(self.depth)
        if packed:
            make = next(make for magic, make in _PACKED if raw.startswith(magic))
            self.unpacker, self.taken, self.fresh = make(), [], True
        self.state = "member" if packed else "plain"
        return raw

    def _member(self, raw: bytes) -> Generator[str, None, bytes]:
        """Takes bytes of a member; the bytes after its end come back."""
        unpacker = self.unpacker
        if self.fresh:
            self.taken.append(raw)
        try:
            while not unpacker.eof:
                out = unpacker.decompress(raw, PART)
                if out:
                    self.fresh, self.taken = False, []
                    yield from self.inner.feed(out)
                raw = getattr(unpacker, "unconsumed_tail", b"")
                if not unpacker.eof and not raw and (len(out) < PART if hasattr(unpacker, "unconsumed_tail") else unpacker.needs_input):
                    return b""
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            taken, self.taken = self.taken, []
            self.state = "plain" if self.fresh and not self.archive else "lost"
            return b"".join(taken)
        self.state = "between"
        return unpacker.unused_data.lstrip(b"\0")


class Reading:
    """Bytes read as text, in windows: byte by byte, as only ASCII can be in a span, and in both orders as UTF-16 where there are zeros."""

    def __init__(self, depth: int):
        self.readers = [(codecs.getincrementaldecoder(name)("replace"), Windows(depth), name != "latin-1") for name in ("latin-1", "utf-16-le", "utf-16-be")]

    def feed(self, raw: bytes, done: bool = False) -> Iterator[str]:
        zero = b"\0" in raw
        for reader, text, wide in self.readers:
            text.shown |= zero or not wide
            for i in range(0, len(raw) or 1, PART):
                last = i + PART >= len(raw)
                yield from text.feed(reader.decode(raw[i : i + PART], done and last), done and last)

    def close(self) -> Iterator[str]:
        return self.feed(b"", True)


class Windows:
    """Text cut into windows of about WINDOW characters, where no span and no run can be open.

    How far back was searched is remembered. A stretch without such a place is cut all the same once it is longer than a window, and OVERLAP
    characters of it are given again: more than a span needs to show that it is there, which is all that is asked of unpacked text, as its
    spans stand for the whole blob. Of spaces, SPACES in a row are as good as more. A base64 run that goes on over
    a cut keeps its alignment, and if it holds an archive, that is unpacked as the run goes on.
    """

    def __init__(self, depth: int):
        self.depth, self.held, self.parts, self.size, self.shown = depth, "", [], 0, False
        self.deep: Unpacking | None = None
        self.quad = ""

    def feed(self, text: str, done: bool) -> Iterator[str]:
        self.parts.append(text)
        self.size += len(text)
        if not done and self.size < WINDOW:
            return
        new = "".join(self.parts)
        self.parts, self.size = [], 0
        if self.deep is not None:
            yield from self._deeper(new, done)
        if " " * SPACES in new:
            new = _SPACES.sub(" " * SPACES, new)
        found = None if done else _APART.search(new[::-1])
        if done or found:
            cut = len(new) - found.start() if found else len(new)
            window, self.held = self.held + new[:cut], new[cut:]
            if window and self.shown:
                yield plain(window)
            self.shown &= bool(self.held)
            return
        self.held += new
        if len(self.held) < WINDOW + OVERLAP:
            return
        window = self.held
        if self.shown:
            yield plain(window)
        run = len(_RUN.match(window[::-1])[0])
        start = len(window) - run
        keep = OVERLAP if run < OVERLAP else OVERLAP + (run - OVERLAP) % 4
        self.held = window[-keep:]
        if self.shown and self.deep is None and run > OVERLAP and self.depth < NESTED:
            at = next((i for i in starts(window[start : start + OVERLAP]) if begins_archive(window, start + i)), None)
            if at is not None:
                self.deep, self.quad = Unpacking(self.depth + 1), ""
                yield from self._deeper(window[start + at :], False)

    def _deeper(self, new: str, done: bool) -> Iterator[str]:
        """Unpacks on, as far as the run goes."""
        body = _RUN.match(new)[0]
        over = done or len(body) < len(new)
        body = self.quad + body
        cut = len(body) if over else len(body) - len(body) % 4
        self.quad = body[cut:]
        for raw in decoded(body[:cut], 0):
            yield from self.deep.feed(raw)
        if over:
            yield from self.deep.close()
            self.deep = None


def plain(window: str) -> str:
    """The stretches of ASCII in a window that are long enough for the shortest span or run, apart from each other."""
    return "\0".join(_PLAIN.findall(window))


def windows(chunks: Iterable[bytes], archive: bool = False) -> Iterator[str]:
    """The text that bytes hold, in windows; if an archive is asked for, only what one that they begin with holds."""
    reader = Unpacking(archive=archive)
    for raw in chunks:
        yield from reader.feed(raw)
        if reader.state == "lost":
            break
    yield from reader.close()


def starts(run: str) -> Iterator[int]:
    """Where in a run of base64 letters a payload may begin: at its start, and after every sign that also parts names."""
    yield 0
    yield from (m.end() for m in _SIGN.finditer(run))


def payloads(run: str) -> Iterator[tuple[int, Iterator[str]]]:
    """(start, windows) of what a run may hold: read from its start, from the first place of each other alignment at which a
    payload may begin, and from every such place where an archive begins."""
    begun = set()
    for i in starts(run):
        if len(run) - i < 16:
            return
        packed = begins_archive(run, i)
        if packed or i % 4 not in begun:
            yield i, windows(decoded(run, i), archive=i % 4 in begun)
            begun.add(i % 4)


def begins_archive(run: str, at: int) -> bool:
    """Whether an archive begins at a place of a base64 run, of which HEAD characters unpack without fault."""
    few = base64_bytes(run[at : at + 12])
    return bool(few) and few.startswith(_MAGIC) and _is_packed(base64_bytes(run[at : at + HEAD]) or b"")


def decoded(run: str, at: int) -> Iterator[bytes]:
    """The bytes that a base64 run holds from a place on, in parts."""
    for i in range(at, len(run), 4 * (PART // 4)):
        yield base64_bytes(run[i : i + 4 * (PART // 4)]) or b""


def base64_bytes(run: str) -> bytes | None:
    """The bytes that a base64 run holds."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[:-1] if len(body) % 4 == 1 else body
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def _joined(text: str) -> Iterator[tuple[str, int, int]]:
    """(run, start, end) of wrapped base64: lines that follow each other, and blocks of equal lines with a last shorter one."""
    for m in _WRAPPED.finditer(text):
        lines = [(x[0], x.start(), x.end()) for x in _LINE.finditer(text, m.start(), m.end()) if x[0][0] != "\\"]
        blocks, i = [(0, len(lines))], 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and len(lines[j][0]) == len(lines[i][0]):
                j += 1
            # What follows the end of a payload does not matter.
            blocks.append((i, j + 1 if j < len(lines) and len(lines[j][0]) < len(lines[i][0]) else j))
            i = j
        for i, j in dict.fromkeys(b for b in blocks if b[1] - b[0] > 1):
            yield "".join(x for x, _, _ in lines[i:j]), lines[i][1], lines[j - 1][2]


def _below(layer: Layer, end: int) -> Iterator[tuple[Layer, int, int]]:
    """The layers that a layer unwraps to, each with the part of the whole text that it stands for."""
    text = layer.text
    if "%" in text or "\\" in text or "&#" in text:
        plain = layer.unescaped()
        if plain is not None:
            yield plain, 0, end
        for m in _BYTES.finditer(text) if "%" in text or "\\x" in text else ():
            if "%" in m[0] or "\\x" in m[0]:
                raw = _BYTE.sub(lambda x: chr(int(x[1], 16)), m[0]).encode("latin-1")
                if _is_packed(raw):
                    a, b = layer.outer(m.start(), m.end())
                    for inner in windows([raw]):
                        yield Layer(inner, [0], [a], [b]), a, b
    runs = [(m[0], m.start(), m.end()) for m in _BASE64.finditer(text)]
    for run, start, stop in [*runs, *_joined(text)] if runs else ():
        # Where lines were joined, the places within the run are not those of the text: they stand for the whole.
        joined = stop - start != len(run)
        for i, held in payloads(run):
            a, b = layer.outer(start if joined else start + i, stop)
            for inner in held:
                yield Layer(inner, [0], [a], [b]), a, b


def all_spans(text: str, base: list[Span] | None = None) -> list[Span]:
    """Base spans and those of every layer below, once each, in order."""
    found = set(base_spans(text) if base is None else base)
    if not text:
        return []
    key = lambda inner, a, b: (hashlib.blake2b(inner.encode("utf-8", "surrogatepass"), digest_size=16).digest(), a, b)
    # Depth first, so that of an archive one window is held.
    work = [_below(Layer(text, [0], [0], [None]), len(text))]
    seen = {key(text, 0, len(text))}
    while work:
        child, a, b = next(work[-1], (None, 0, 0))
        if child is None:
            work.pop()
            continue
        mark = key(child.text, a, b)
        if not child.text or mark in seen:
            continue
        seen.add(mark)
        for start, kind, end in base_spans(child.text):
            first, last = child.outer(start, end)
            found.add((first, kind, last))
        work.append(_below(child, len(text)))
    return sorted(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base, spans) for every row: arrays of (kind, start, end) in code points, end exclusive.

    base has the plain patterns of the text itself, spans those and what decoded
    layers hold. A span found in a layer covers the characters it was decoded
    from. Null counts as empty; rows that repeat are scanned each; an empty table gives none. Only the two columns
    named are read, so others may have any name. A text itself is held whole with its layers of escapes, what its runs and archives
    hold a window at a time, however long that is; bytes are taken as text where 12 or more of ASCII are together, which every span and run has.
    """
    kind = dict(docs.dtypes)[id_col]
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
        for whole in batches:
            for i in range(0, len(whole), 512):
                batch = whole.slice(i, 512)
                bases, every = [], []
                for value in batch.column(1):
                    own = value.as_py() or ""
                    base = base_spans(own)
                    bases.append(shown(base))
                    every.append(shown(all_spans(own, base)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, item), pa.array(every, item)], names=[id_col, "base", "spans"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, base {spans}, spans {spans}")


_JOIN = "array_join(transform({0}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: secrets in every document."""
    count = "cast(size(filter(base, x -> x.kind = '{0}')) as long) n_{0}"
    return scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", *(count.format(k) for k in KINDS), f"sha2({_JOIN.format('base')}, 256) base_sha256", f"{_JOIN.format('spans')} spans"
    )
