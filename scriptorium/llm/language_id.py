"""Language identification with spans for mixed-language text.

A word's script narrows the candidate languages; each candidate scores the word
by hashed byte n-grams; a Viterbi pass over a text's words with a penalty for
switching labels spans. The text's language is the one whose spans hold most
of its words' bytes. How much likelier than by chance its language makes a word's
n-grams tells words of a learned language from others, in mixed texts too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import crc32_of, table
from scriptorium.llm.textbytes import LOWER, U, Slice, mix, row_sums, slices

#: Hashed n-grams per kind; the kinds are pairs, triples and quadruples of bytes and whole words.
BITS = 15
KINDS = 4
#: Documents to learn from at most (in expectation; they are chosen by a hash of the id).
TRAIN_ROWS = 20_000
#: Log-likelihood that a change of language between words costs.
SWITCH = 12.0
#: A language is a candidate for a script that makes up this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Kinds of n-grams (triples and quadruples) by which words are explained. A word is if its n-grams gain this
#: share of what those of its language's own texts gain over chance. On sf0.1 (learned from half of it, 2500
#: documents of the other half), 0.60 of the letters or more are explained in every document; in those of a
#: language left out of learning, under 0.5 in 2481 of 2500.
EXPLAIN_KINDS, EXPLAIN = (1, 2), 0.4

#: Words whose labels are found together, unless a single text has more.
GROUP_WORDS = 200_000
#: Words that a pass of the Viterbi search takes one after the other, and at least so many for each label, so that what is kept of
#: a long row's passes, a number for every two labels, is less than its words' scores.
STRETCH, LABEL_WORDS = 128, 8
#: Labels beyond which a pass for each of them takes longer than to go through a row word by word.
PASS_LABELS = 40

# Blocks of code points by script, as the Unicode standard lays them out.
BLOCKS = (
    ("Latin", 0x41, 0x5A), ("Latin", 0x61, 0x7A), ("Latin", 0xAA, 0xAA), ("Latin", 0xBA, 0xBA), ("Latin", 0xC0, 0xD6), ("Latin", 0xD8, 0xF6), ("Latin", 0xF8, 0x2AF),
    ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Armenian", 0x530, 0x58F), ("Hebrew", 0x590, 0x5FF), ("Arabic", 0x600, 0x6FF), ("Syriac", 0x700, 0x74F),
    ("Arabic", 0x750, 0x77F), ("Thaana", 0x780, 0x7BF), ("Nko", 0x7C0, 0x7FF), ("Arabic", 0x860, 0x8FF), ("Devanagari", 0x900, 0x97F), ("Bengali", 0x980, 0x9FF),
    ("Gurmukhi", 0xA00, 0xA7F), ("Gujarati", 0xA80, 0xAFF), ("Oriya", 0xB00, 0xB7F), ("Tamil", 0xB80, 0xBFF), ("Telugu", 0xC00, 0xC7F), ("Kannada", 0xC80, 0xCFF),
    ("Malayalam", 0xD00, 0xD7F), ("Sinhala", 0xD80, 0xDFF), ("Thai", 0xE00, 0xE7F), ("Lao", 0xE80, 0xEFF), ("Tibetan", 0xF00, 0xFFF), ("Myanmar", 0x1000, 0x109F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Ethiopic", 0x1200, 0x139F), ("Cherokee", 0x13A0, 0x13FF), ("Canadian", 0x1400, 0x167F),
    ("Runic", 0x16A0, 0x16FF), ("Khmer", 0x1780, 0x17FF), ("Mongolian", 0x1800, 0x18AF), ("Georgian", 0x1C90, 0x1CBF), ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x1F00, 0x1FFF),
    ("Latin", 0x2C60, 0x2C7F), ("Georgian", 0x2D00, 0x2D2F), ("Tifinagh", 0x2D30, 0x2D7F), ("Ethiopic", 0x2D80, 0x2DDF), ("Cyrillic", 0x2DE0, 0x2DFF), ("Han", 0x2E80, 0x2FDF),
    ("Han", 0x3005, 0x3007), ("Kana", 0x3041, 0x30FF), ("Bopomofo", 0x3100, 0x312F), ("Hangul", 0x3130, 0x318F), ("Kana", 0x31F0, 0x31FF), ("Han", 0x3400, 0x4DBF),
    ("Han", 0x4E00, 0x9FFF), ("Yi", 0xA000, 0xA4CF), ("Cyrillic", 0xA640, 0xA69F), ("Latin", 0xA720, 0xA7FF), ("Hangul", 0xA960, 0xA97F), ("Myanmar", 0xA9E0, 0xA9FF),
    ("Ethiopic", 0xAB00, 0xAB2F), ("Latin", 0xAB30, 0xAB6F), ("Cherokee", 0xAB70, 0xABBF), ("Hangul", 0xAC00, 0xD7FF), ("Han", 0xF900, 0xFAFF), ("Latin", 0xFB00, 0xFB06),
    ("Armenian", 0xFB13, 0xFB17), ("Hebrew", 0xFB1D, 0xFB4F), ("Arabic", 0xFB50, 0xFDFF), ("Arabic", 0xFE70, 0xFEFC), ("Latin", 0xFF21, 0xFF3A), ("Latin", 0xFF41, 0xFF5A),
    ("Kana", 0xFF66, 0xFF9F), ("Hangul", 0xFFA0, 0xFFDC), ("Supplementary", 0x10000, 0x1EFFF), ("Han", 0x20000, 0x323AF),
)
SCRIPTS = ["none", *dict.fromkeys(name for name, _, _ in BLOCKS)]
_LOW = np.array([lo for _, lo, _ in BLOCKS])
_HIGH = np.array([hi for _, _, hi in BLOCKS])
_NUMBER = np.array([SCRIPTS.index(name) for name, _, _ in BLOCKS], dtype=np.int8)

_LETTER = regex.compile(r"\p{L}")


def code_scripts(codes: np.ndarray) -> np.ndarray:
    """Script number of every code point, 0 for those in no block of BLOCKS."""
    at = np.maximum(np.searchsorted(_LOW, codes, side="right") - 1, 0)
    return np.where((codes >= _LOW[at]) & (codes <= _HIGH[at]), _NUMBER[at], np.int8(0))


_ASCII = code_scripts(np.arange(128))


def byte_scripts(data: np.ndarray) -> np.ndarray:
    """Script number of every byte that begins a letter, 0 elsewhere."""
    out = np.zeros(len(data), dtype=np.int8)
    plain = data < 0x80
    out[plain] = _ASCII[data[plain]]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        # A broken character at the end takes zeros for what it lacks.
        after = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
        first = data[lead].astype(np.int64)
        size = 1 + (first >= 0xE0) + (first >= 0xF0)
        codes = first & np.array([0, 0x1F, 0x0F, 0x07])[size]
        for k in (1, 2, 3):
            codes = np.where(size >= k, (codes << 6) | (after[lead + k] & 0x3F), codes)
        out[lead] = code_scripts(codes)
    return out


def grams(part: Slice) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple]:
    """Per kind of n-gram its hashes and the byte that each ends at; and the words.

    A word's n-grams see one space before it, so beginnings count.
    """
    starts, ends, first = part.words()
    low = Slice(LOWER[part.data], part.offsets)
    out = []
    if len(starts):
        edges = np.zeros(len(part.data) + 1, dtype=np.int8)
        edges[starts] += 1
        edges[ends] -= 1
        at = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8))
        depth = at - np.repeat(starts, ends - starts)
        code = low.data[at].astype(U)
        before = [np.concatenate([np.full(k, 32, dtype=U), code])[: len(code)] for k in (1, 2, 3)]
        for k in (1, 2, 3):
            before[k - 1] = np.where(depth >= k, before[k - 1], np.where(depth == k - 1, U(32), U(0)))
        h = code + U(257)
        for k in (1, 2, 3):
            h = h * U(259) + before[k - 1]
            out.append(((mix(h + U(k)) >> U(64 - BITS)).astype(np.int64), at))
        out.append(((mix(low.hashes(starts, ends) + U(9)) >> U(64 - BITS)).astype(np.int64), starts))
    return out, (starts, ends, first)


@dataclass
class Model:
    """Languages, log-likelihoods (KINDS x 2**BITS x languages, less their mean over the languages) and candidates
    (scripts x languages); that mean over chance, and the least gain a byte of a word that a language explains."""

    langs: list[str]
    table: np.ndarray
    candidate: np.ndarray
    common: np.ndarray
    least: np.ndarray


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for i, j, part in slices(batch.column("text")):
            kinds, _ = grams(part)
            here = langs[i:j]
            scripts = byte_scripts(part.data)
            for lang in sorted(set(here)):
                own = sums.setdefault(lang, np.zeros(KINDS * 2**BITS + len(SCRIPTS), dtype=np.int64))
                rows = here == lang
                of = np.repeat(rows, np.diff(part.offsets))
                for k, (h, at) in enumerate(kinds):
                    own[k * 2**BITS : (k + 1) * 2**BITS] += np.bincount(h[of[at]], minlength=2**BITS)
                own[KINDS * 2**BITS :] += np.bincount(scripts[of], minlength=len(SCRIPTS))
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])], names=["lang", "cell", "n"])


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from the texts and non-null lang of docs (doc_id, text, lang).

    The sample keeps rows whose id hash lies below train_rows / their number.
    The driver gets at most KINDS * 2**BITS counts for each language.
    """
    known = docs.where("lang is not null and text is not null")
    share = min(1.0, train_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))
    got = chosen.select("text", "lang").mapInArrow(_counts, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    size = KINDS * 2**BITS
    n = np.zeros((size + len(SCRIPTS), len(langs)))
    n[got["cell"].to_numpy(dtype=np.int64), got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    cells = n[:size].reshape(KINDS, 2**BITS, len(langs))
    logs = np.log(cells + 0.5) - np.log(cells.sum(axis=1, keepdims=True) + 0.5 * 2**BITS)
    mean = logs.mean(axis=2, keepdims=True) if langs else np.zeros((KINDS, 2**BITS, 1))
    share = cells / np.maximum(cells.sum(axis=1, keepdims=True), 1)
    least = EXPLAIN * (share * (logs + BITS * np.log(2)))[list(EXPLAIN_KINDS)].sum(axis=(0, 1))
    logs -= mean
    letters = n[size:]
    candidate = letters > SCRIPT_SHARE * np.maximum(letters[1:].sum(axis=0), 1)
    return Model(langs, logs.astype(np.float32), candidate, (mean[:, :, 0] + BITS * np.log(2)).astype(np.float32), least)


def word_scores(model: Model, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word: score of each language, whether it explains the word, letters' bytes; and the words' spans; and the first word of each row."""
    kinds, (starts, ends, first) = grams(part)
    n = len(model.langs)
    out = np.zeros((len(starts), n), dtype=np.float32)
    if not len(starts):
        return out, np.zeros((0, n), dtype=bool), np.zeros(0, dtype=np.int64), starts, first
    size = ends - starts
    word_of = np.concatenate([[0], np.cumsum(size)])
    gain = np.zeros((len(starts), n), dtype=np.float32)
    for k, (h, _) in enumerate(kinds[:-1]):
        if k in EXPLAIN_KINDS:
            sums = np.concatenate([[0.0], np.cumsum(model.common[k][h], dtype=np.float64)])
            gain += (sums[word_of[1:]] - sums[word_of[:-1]])[:, None]
        for lang in range(n):
            sums = np.concatenate([[0.0], np.cumsum(model.table[k, :, lang][h], dtype=np.float64)])
            own = sums[word_of[1:]] - sums[word_of[:-1]]
            out[:, lang] += own
            if k in EXPLAIN_KINDS:
                gain[:, lang] += own
    explained = gain >= model.least * size[:, None]
    out += model.table[KINDS - 1][kinds[-1][0]]
    scripts = byte_scripts(part.data)
    script = np.maximum.reduceat(scripts, starts)
    letters = row_sums((scripts > 0).astype(np.int64), np.append(starts, len(part.data)))
    allowed = model.candidate[script]
    narrowed = allowed.any(axis=1) & ~allowed.all(axis=1)
    out[narrowed] = np.where(allowed[narrowed], out[narrowed], -1e4)
    out[letters == 0] = 0
    return out, explained, letters, starts, first


def lettered_bytes(part: Slice, starts: np.ndarray) -> np.ndarray:
    """For every word, its bytes that are a letter of ASCII or belong to a character beyond it, of any script."""
    low = LOWER[part.data]
    counts = ((low >= 0x80) | ((low >= 0x61) & (low <= 0x7A))).astype(np.int64)
    return row_sums(counts, np.append(starts, len(part.data)))


def _forward(emit: np.ndarray, heads: np.ndarray, steps: np.ndarray, best: np.ndarray, switch: float, back: list[np.ndarray] | None = None) -> np.ndarray:
    """Passes over the words from ``heads`` on, all together, the longest first: the best value of every end label.

    ``best`` has what each label starts with. Where asked for, ``back`` is given each word's label before for every label.
    """
    live = np.searchsorted(-steps, -np.arange(1, steps[0] + 1), side="right") if len(steps) else []
    own = np.arange(emit.shape[1], dtype=np.int16)
    best = best + emit[heads]
    for t in range(1, len(live)):
        k = live[t]
        now = best[:k]
        top = now.argmax(axis=1)
        jump = now[np.arange(k), top][:, None] - np.float32(switch)
        stay = now >= jump
        if back is not None:
            back.append(np.where(stay, own, top[:, None].astype(np.int16)))
        best[:k] = np.where(stay, now, jump) + emit[heads[:k] + t]
    return best


def viterbi(emit: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every word, rows side by side.

    Rows are cut into stretches of STRETCH words, or of LABEL_WORDS a label if that is more, but left whole if there are more than PASS_LABELS
    labels. Of a row with several, the first is passed
    through once and the others once for each label that the word before may have, for the values at their ends alone, which tell
    with which label each stretch of the best path begins and ends. Every stretch is then passed through once more from there, remembering
    the way. All move together, a word at a time, so that a long row takes no more steps than a short one, and
    what is remembered is a number for every word and label.
    """
    n_words, n = emit.shape
    labels = np.zeros(n_words, dtype=np.int16)
    counts = np.diff(first)
    if n == 1 or not n_words:
        return labels
    length = max(STRETCH, LABEL_WORDS * n) if n <= PASS_LABELS else counts.max()
    parts = -(-counts // length)
    lead = np.concatenate([[0], np.cumsum(parts)])
    row = np.repeat(np.arange(len(counts)), parts)
    ordinal = np.arange(lead[-1]) - lead[row]
    begin = first[row] + ordinal * length
    size = np.minimum(length, first[row + 1] - begin)
    own = np.arange(n, dtype=np.int16)
    entered = lambda label: np.where(own == label[:, None], np.float32(0), np.float32(-switch))
    entry = np.zeros((len(row), n), dtype=np.int16)
    end = np.full(len(row), -1, dtype=np.int16)
    chosen = np.zeros(len(row), dtype=np.int16)
    rows = np.flatnonzero(parts > 1)
    rows = rows[np.argsort(-parts[rows], kind="stable")]
    if len(rows):
        # Passes: a stretch's ones follow each other by the label before it.
        runs = np.where(parts[row] == 1, 0, np.where(ordinal == 0, 1, n))
        of = np.concatenate([[0], np.cumsum(runs)])
        stretch = np.repeat(np.arange(len(row)), runs)
        before = np.arange(of[-1]) - of[stretch]
        order = np.argsort(-size[stretch], kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        stretch, before = stretch[order], before[order]
        opened = np.where((ordinal[stretch] == 0)[:, None], np.float32(0), entered(before))
        best = _forward(emit, begin[stretch], size[stretch], opened, switch)
        # The best value of every end label, stretch after stretch, and the label before that leads to it.
        value = best[place[of[lead[rows]]]].astype(np.float64)
        for k in range(1, parts.max()):
            some = np.searchsorted(-parts[rows], -k, side="left")
            at = lead[rows[:some]] + k
            through = value[:some, :, None] + best[place[of[at][:, None] + own]]
            entry[at] = through.argmax(axis=1)
            value[:some] = through.max(axis=1)
        now = value.argmax(axis=1).astype(np.int16)
        for k in range(parts.max() - 1, -1, -1):
            some = np.searchsorted(-parts[rows], -k, side="left")
            at = lead[rows[:some]] + k
            end[at] = now[:some]
            chosen[at] = now[:some] = entry[at, now[:some]]
    order = np.argsort(-size, kind="stable")
    heads, steps = begin[order], size[order]
    back: list[np.ndarray] = []
    opened = np.where((ordinal[order] == 0)[:, None], np.float32(0), entered(chosen[order]))
    best = _forward(emit, heads, steps, opened, switch, back)
    now = np.where(end[order] < 0, best.argmax(axis=1), end[order])
    for t in range(steps[0] - 1, -1, -1):
        k = np.searchsorted(-steps, -(t + 1), side="right")
        labels[heads[:k] + t] = now[:k]
        if t:
            now[:k] = back[t - 1][np.arange(k), now[:k]]
    return labels


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, lang_pred, score, explained, spans) of every row of docs; only keep and text are read.

    spans has (lang, start, end) in bytes of UTF-8, words of one label running
    together. score is the share of letters in spans of lang_pred times the odds
    that it beats the next language over the whole text. explained is the share
    of letters in words that the language of their span explains: near 1 for
    text in learned languages, mixed or not, and low in others and in key-mash.
    Null texts and texts without a letter get und, score and explained 0 and no
    spans; so does everything if nothing was learned. Rows that repeat give a row each, of ties between
    languages the one first in name is taken, and an empty table gives none. Columns other than keep and text may have any name;
    one of keep must not have the name of a result. A text is held whole, with a score for each of its words and languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("_text")
            # Words of many slices go through the Viterbi pass together.
            group, size = [], 0
            for i, j, part in slices(texts):
                emit, explained, letters, starts, first = word_scores(model, part)
                group.append((i, j, part, emit, explained, letters, starts, first))
                size += len(emit)
                if size > GROUP_WORDS:
                    yield from label(batch, group, model)
                    group, size = [], 0
            if group:
                yield from label(batch, group, model)

    def label(batch, group, model):
        heads, shift = [np.zeros(1, dtype=np.int64)], 0
        for *_, starts, first in group:
            heads.append(first[1:] + shift)
            shift += len(starts)
        first = np.concatenate(heads)
        emit = np.concatenate([g[3] for g in group])
        letters = np.concatenate([g[5] for g in group])
        n, rows = len(model.langs), len(first) - 1
        if n:
            path = viterbi(emit, first)
            held = np.zeros((rows, n))
            row_of = np.repeat(np.arange(rows), np.diff(first))
            np.add.at(held, (row_of, path), letters)
            total = np.stack([row_sums(emit[:, k].astype(np.float64), first) for k in range(n)], axis=1)
            pred = np.where(held.max(axis=1) > 0, held.argmax(axis=1), total.argmax(axis=1))
            mine = total[np.arange(rows), pred]
            rest = total.copy()
            rest[np.arange(rows), pred] = -np.inf
            margin = np.clip(mine - rest.max(axis=1), -30, 30) if n > 1 else np.full(rows, 30.0)
            score = held[np.arange(rows), pred] / np.maximum(held.sum(axis=1), 1) / (1 + np.exp(-margin))
            known = np.concatenate([g[4] for g in group])[np.arange(len(path)), path]
            sizes = np.concatenate([lettered_bytes(g[2], g[6]) for g in group])
            explained = row_sums(sizes * known, first) / np.maximum(row_sums(sizes, first), 1)
        low = group[0][0]
        names, spans = [], []
        for i, j, part, *_, starts, heads in group:
            texts = None
            plain = row_sums((byte_scripts(part.data) > 0).astype(np.int64), part.offsets)
            for r in range(j - i):
                lettered = plain[r] > 0
                if not lettered or part.data[part.offsets[r] : part.offsets[r + 1]].max() > 127:
                    texts = texts if texts is not None else batch.column("_text").slice(i, j - i)
                    lettered = bool(_LETTER.search(texts[r].as_py() or ""))
                if not lettered or not n:
                    names.append(UNKNOWN)
                    score_at = i + r - low
                    if n:
                        score[score_at] = explained[score_at] = 0.0
                    spans.append([])
                    continue
                names.append(model.langs[pred[i + r - low]])
                a, b = first[i + r - low], first[i + r - low + 1]
                turn = np.flatnonzero(path[a + 1 : b] != path[a : b - 1]) + 1
                begin = starts[heads[r] + np.concatenate([[0], turn])] - part.offsets[r] if b > a else []
                stop = np.append(begin[1:], part.offsets[r + 1] - part.offsets[r]) if b > a else []
                tags = path[a + np.concatenate([[0], turn])] if b > a else []
                spans.append([{"lang": model.langs[x], "start": int(s), "end": int(e)} for x, s, e in zip(tags, begin, stop)])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k).slice(low, rows) for k in range(len(keep))], pa.array(names, pa.string()), pa.array(score if n else np.zeros(rows)), pa.array(explained if n else np.zeros(rows)), pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
            names=[*keep, "lang_pred", "score", "explained", "spans"],
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, lang_pred string, score double, explained double, spans array<struct<lang:string,start:long,end:long>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc32_of(F.col("doc_id")), F.lit(5)) == 0
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
