"""Language identification by cross-parsing entropy.

Per language a reference of labelled text is made into a suffix automaton.  A text is cross-parsed against it: from each
point the longest string that occurs in the reference is one phrase.  A text in the reference's language has long matches
and so few phrases; `phrases * log2(reference length) / characters` is its cross entropy in bits, and the language with
the least wins.

Letters are lower-cased and all else is one space.  Texts are parsed in blocks of `BLOCK` characters, side by side, each
block of every text, so that numpy steps through all blocks at once; a text's phrases are summed over its blocks.  The
sample that is learned from is bounded (`rows_per_language` rows of at most `chars_per_row` characters, `reference_chars`
characters in all for each language, however many there are); workers build the automata from it and keep them, those of
many languages as lists of transitions of which one at a time is spread out.

Defined cases: a null text, or one without a letter, is `und` with score 0.  Between equal languages the first by name
wins.  Without any labelled text every text is `und`.  Repeated rows are judged each by itself; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import copy
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.registry import query

UND = "und"
BLOCK = 256
SLICE = 2 << 20
AT_ONCE = 64  # languages whose sample is gathered at once
SPREAD = 8  # languages whose tables stay spread out
LETTERS, FOLDED = 95, 32  # letters with a symbol of their own, and symbols that the others share
FOUND = ["lang_pred", "score", "bits", "plausible"]
SPARE, DEVIATIONS, ABOVE = 3, 3, 1.25  # texts that tell a language's spread; a limit is so much above so many deviations
MOST_PHRASES = 0.8  # a character, that any limit allows
SHORT_MARGIN = 4  # over the square root of the characters: how much more a text may need because it is short
SHARPNESS = 0.1  # how much a bit of difference counts in the score


@dataclass(frozen=True)
class Model:
    """References by language, in order of name, and the cross entropy that a language's own long texts hardly exceed."""

    references: tuple[tuple[str, str], ...]
    usual_bits: tuple[float, ...] = ()


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text has remainder `fold`; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def normalised(text: str) -> str:
    return " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


def learn(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 300,
    chars_per_row: int = 2000,
    reference_chars: int = 40_000,
) -> Model:
    """A model of a bounded sample: rows are chosen by the hash of their text, equally many of each language."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(F.col(text)).alias("h")
    )
    counts = rows.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).orderBy("l").collect()
    if not counts:
        return Model(())
    references: list[tuple[str, str]] = []
    rest: list[list[str]] = []
    for i in range(0, len(counts), AT_ONCE):
        for language, parts in _texts(rows, counts[i : i + AT_ONCE], rows_per_language, chars_per_row):
            kept, size = [], 0
            while parts and size < reference_chars and (not kept or len(parts) > 1):
                kept.append(parts.pop(0))
                size += len(kept[-1])
            references.append((language, "".join(kept)[:reference_chars]))
            rest.append([p for p in parts if len(p) > 200][:100])
    parser = _Parser(tuple(references))
    flat = [p for parts in rest for p in parts]
    bits = np.concatenate([np.empty((0, len(rest))), *(parser.bits(flat[k : k + 1000]) for k in range(0, len(flat), 1000))])
    ends = np.cumsum([len(parts) for parts in rest])
    limits = []
    for i, end in enumerate(ends):
        own = bits[end - len(rest[i]) : end]
        limits.append(_limit(own[np.argmin(own, axis=1) == i, i]))  # others are labelled wrongly
    known = [x for x in limits if x is not None]
    usual = []
    for i, (_, reference) in enumerate(references):
        limit = limits[i]
        if limit is None:  # from the reference alone: the second half by the first
            half = len(reference) // 2
            second = parser.alone(reference[:half]).bits([reference[k : k + 200] for k in range(half, len(reference), 200)])[:, 0]
            limit = max(_limit(second, 1) or math.inf, float(np.median(known)) if known else 0.0)
        usual.append(min(limit, MOST_PHRASES * parser.scale[i]))
    return Model(tuple(references), tuple(float(u) for u in usual))


def _limit(bits: np.ndarray, least: int = SPARE) -> float | None:
    """Above what a language's texts need, judged by their median and the median deviation, which a few odd ones do not move."""
    bits = bits[np.isfinite(bits)]
    if len(bits) < least:
        return None
    middle = np.median(bits)
    return float(ABOVE * (middle + DEVIATIONS * 1.4826 * np.median(np.abs(bits - middle))))


def _texts(rows: DataFrame, counts: list, rows_per_language: int, chars_per_row: int) -> list[tuple[str, list[str]]]:
    """Different sampled texts of some languages, in order of language and hash."""
    share = F.create_map(*(x for r in counts for x in (F.lit(r["l"]), F.lit(min(1.0, rows_per_language / r["n"])))))
    drawn = F.pmod("h", F.lit(1 << 20)) < share[F.col("l")] * (1 << 20)
    some = rows.filter(F.col("l").isin([r["l"] for r in counts]))
    sample = some.filter(drawn).groupBy("l", "h").agg(F.first(F.substring("t", 1, chars_per_row)).alias("t"))  # copies count once
    texts: dict[str, dict[str, None]] = {}
    for r in sorted(sample.limit(4 * rows_per_language * len(counts)).collect(), key=lambda r: (r["l"], r["h"], r["t"])):
        texts.setdefault(r["l"], {})[normalised(r["t"])] = None
    return [(language, list(parts)) for language, parts in sorted(texts.items())]


def automaton(symbols: list[int], width: int) -> np.ndarray:
    """Dense transitions of the suffix automaton of a symbol string: state * width + symbol -> state, -1 for none."""
    next_, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(next_)
        next_.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in next_[p]:
            next_[p][c] = new
            p = link[p]
        if p != -1:
            q = next_[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(next_)
                next_.append(dict(next_[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and next_[p].get(c) == q:
                    next_[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    table = np.full((len(next_), width), -1, "i4")
    for state, moves in enumerate(next_):
        for c, to in moves.items():
            table[state, c] = to
    return table


class _Parser:
    def __init__(self, references: tuple[tuple[str, str], ...]):
        seen = Counter(c for _, r in references for c in r if c != " ")
        own = {c: i + 1 for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LETTERS])}
        folds = FOLDED if len(seen) > LETTERS else 1  # one symbol for letters that no reference has
        self.width = 1 + len(own) + folds
        self.symbol = np.zeros(0x110000, "u1")
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                self.symbol[code] = own.get(c.lower()[:1], 1 + len(own) + code % folds)
        self.languages = [language for language, _ in references]
        self.tables, self.unknown, self.scale = [], [], []
        self.many = len(references) > SPREAD
        for _, reference in references:
            self._add(reference)

    def _add(self, reference: str) -> None:
        table = automaton(self.symbols(reference).tolist(), self.width)
        unknown = table[0] < 0
        table[0, unknown] = 0  # an unknown letter is a phrase by itself and leads nowhere
        table = table.ravel()
        if self.many:
            places = np.flatnonzero(table >= 0).astype("i4")
            self.tables.append((len(table), places, table[places]))
        else:
            self.tables.append(table)
        self.unknown.append(unknown)
        self.scale.append(math.log2(max(2, len(reference))))

    def alone(self, reference: str) -> _Parser:
        """A parser of one reference with this one's symbols."""
        other = copy.copy(self)
        other.tables, other.unknown, other.scale = [], [], []
        other._add(reference)
        return other

    def spread(self, i: int) -> np.ndarray:
        table = self.tables[i]
        if isinstance(table, tuple):
            size, places, to = table
            table = np.full(size, -1, "i4")
            table[places] = to
        return table

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le"), "u4")]

    def bits(self, texts: list[str]) -> np.ndarray:
        """Cross entropy of each text (row) in each language (column), in bits per character; infinite without a letter."""
        return self.phrases(texts)[0]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character, and the characters that were parsed, of each text."""
        n = np.array([len(t) for t in texts], "i8")
        symbols = self.symbols("".join(texts))
        owner = np.repeat(np.arange(len(texts)), n)
        # Runs of what is no letter become one space; a text begins with none.
        before = np.concatenate([[0], symbols[:-1]]) if len(symbols) else symbols
        starts = np.zeros(len(symbols), bool)
        starts[(np.cumsum(n) - n)[n > 0]] = True
        keep = (symbols != 0) | ((before != 0) & ~starts)
        symbols, owner = symbols[keep], owner[keep]
        size = np.bincount(owner, minlength=len(texts))
        letters = np.bincount(owner[symbols != 0], minlength=len(texts))
        place = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
        blocks = -(-size // BLOCK)
        first = np.cumsum(blocks) - blocks
        total = int(blocks.sum())
        # Position-major, and longer blocks first, so that each step reads one run of memory.
        filled = np.minimum(BLOCK, np.repeat(size, blocks) - BLOCK * (np.arange(total) - np.repeat(first, blocks)))
        order = np.argsort(-filled, kind="stable")
        rank = np.empty(total, "i8")
        rank[order] = np.arange(total)
        grid = np.zeros((BLOCK, total), "u1")
        grid[place % BLOCK, rank[first[owner] + place // BLOCK]] = symbols
        live = np.searchsorted(-filled[order], -np.arange(BLOCK), side="left")  # blocks that have a character at each place
        out = np.empty((len(texts), len(self.tables)))
        of_block = np.repeat(np.arange(len(texts)), blocks)[order]
        for i, (unknown, scale) in enumerate(zip(self.unknown, self.scale, strict=True)):
            table = self.spread(i)
            state, found = np.zeros(total, "i4"), np.zeros(total, "i4")
            root = table[: self.width]
            for step in range(BLOCK):
                m = live[step]
                if not m:
                    break
                c = grid[step, :m]
                to = table[state[:m] * self.width + c]
                missed = to < 0
                found[:m] += missed
                found[:m] += unknown[c]
                state[:m] = np.where(missed, root[c], to)
            found += state != 0  # the phrase that the block's end cuts
            out[:, i] = np.bincount(of_block, weights=found, minlength=len(texts)) * scale
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(letters[:, None] > 0, out / size[:, None], np.inf), np.where(letters > 0, size, 0)


def _parser(model: Model) -> _Parser:
    """One per worker process and model."""
    return common.kept(("languages", model.references), lambda: _Parser(model.references))


def judged(model: Model, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
    """Language, score, bits per character, and whether the text reads like one in that language, of each text."""
    if not model.references:
        return [(UND, 0.0, None, False)] * len(texts)
    parser = _parser(model)
    bits, size = parser.phrases(texts)
    best = np.argmin(bits, axis=1)
    out = []
    for i, b in enumerate(best):
        if not size[i]:
            out.append((UND, 0.0, None, False))
            continue
        odds = np.exp(-SHARPNESS * np.minimum(6000.0, (bits[i] - bits[i, b]) * size[i]))
        like = bool(bits[i, b] <= model.usual_bits[b] * (1 + SHORT_MARGIN / math.sqrt(size[i])))
        out.append((parser.languages[b], float(1 / odds.sum()), float(bits[i, b]), like))
    return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` and lang_pred, score, bits and plausible, which replace columns of these names.

    `plausible` is false for texts without a letter, and for texts that need more bits than the language's limit, which
    is a quarter above the median of its sampled texts and three deviations, and higher for a short text.
    """

    @F.pandas_udf("lang_pred string, score double, bits double, plausible boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            out = []
            for batch in common.pieces_of(pa.record_batch([pa.array(series, pa.string())], ["t"]), "t", SLICE):
                out += judged(model, [t or "" for t in batch.column("t").to_pylist()])
            common.release_memory()
            yield pd.DataFrame(out, columns=FOUND).astype({"bits": "float64"})

    rest = [c for c in docs.columns if c not in FOUND]
    return docs.select(*rest, of(docs[text]).alias("_found")).select(*rest, "_found.*")


def learned(documents: DataFrame) -> Model:
    """From labelled documents that are not held out (remainder 2 of 4)."""
    return learn(documents.filter(~held_out(F.col("doc_id"), 4, 2)))


@query("op1_language_id")
def op1_language_id(spark, folder):
    documents = common.read(spark, folder, "documents")
    found = identify(documents.select("doc_id", "text"), learned(documents))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "bits", "plausible")
