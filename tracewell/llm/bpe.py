"""Byte-level BPE encoding and decoding by recursive SQL.

The pattern cuts a text into words (with the space before them).  A word that is in the vocabulary is its id.  Of every
other word the bytes are the tokens to begin with, and a recursive DuckDB query contracts pairs: each step unnests the
words to rows (word, position, token), neighbours join the merge table, the lowest rank of each word is found, and its
leftmost pair becomes one token, until no pair of the word is in the table.  Long words take all places of their lowest pair in one step, which is the same whenever no token
made from the pair's token has a lower rank than that token; where one has, they too take the leftmost place only.
An ordered aggregation over the ids then gives back the bytes.

A long word is first cut where no token of the vocabulary that occurs in it crosses: no merge can cross there either, so
the parts are contracted by themselves.  A recursion keeps its steps, so it takes a bounded number of bytes and of steps;
words that are not finished go into the next one, and the engine may spill to the task's temp folder.

Each task runs its own in-process query engine on the words it has not met before; a bounded memory of words and of the
parts between spaces serves the others.  Rows stay where they are: nothing is shuffled or collected.

Defined cases: a null text is the empty one: no ids, empty `ids`, no bytes.  Repeated rows are encoded each by itself;
other columns are ignored; an empty table gives no rows.  Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import os
import tempfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.registry import query
from tracewell.llm.tokens import Generations, PartCache

LONG_WORD = 48  # bytes from which a word takes all places of a pair at once
WORDS_AT_ONCE, BYTES_AT_ONCE = 80_000, 1 << 20  # that begin a recursion; a longer part is one of its own
ROWS_AT_ONCE = 2 << 20  # that a recursion over tokens keeps, all its steps together; two steps at least
SLICE = 12 << 20  # of text whose new words are contracted together: each recursion has a fixed price

# Every step keeps the words that changed; a word's last step is its result, unfinished if it is the last allowed one.
LEFTMOST = """
    WITH RECURSIVE s(step, w, x) AS (
      SELECT 0, w, x FROM words_in_bytes
      UNION ALL
      (WITH near AS (SELECT w, unnest(x[:-2]) AS t, unnest(x[2:]) AS u, unnest(range(1, len(x))) AS p FROM s),
            low AS (SELECT w, min(m.c::BIGINT << 32 | p) AS k FROM near JOIN merges m ON m.a = t AND m.b = u GROUP BY w)
       SELECT step + 1, s.w, x[:(k & 4294967295) - 1] || [(k >> 32)::INT] || x[(k & 4294967295) + 2:]
       FROM s JOIN low ON s.w = low.w WHERE step < {most}))
    SELECT w, arg_max(x, step) AS x, max(step) AS step FROM s GROUP BY w"""

ALL_PLACES = """
    WITH RECURSIVE s(step, w, p, t) AS (
      SELECT 0, w, unnest(range(len(x)))::INT, unnest(x) FROM words_in_bytes
      UNION ALL
      (WITH near AS (SELECT *, lead(t) OVER o AS u, lead(p) OVER o AS q FROM s WINDOW o AS (PARTITION BY w ORDER BY p)),
            pair AS (SELECT w, p, q, t = u AS twin, m.c FROM near JOIN merges m ON m.a = t AND m.b = u),
            low AS (SELECT w, min(c) AS c, arg_min(p, c::BIGINT << 32 | p) AS leftmost FROM pair GROUP BY w),
            hit AS (SELECT pair.*, lag(q) OVER (PARTITION BY pair.w ORDER BY pair.p) AS before
                    FROM pair JOIN low ON pair.w = low.w AND pair.c = low.c LEFT JOIN one_by_one x ON x.c = low.c
                    WHERE x.c IS NULL OR pair.p = leftmost),
            run AS (SELECT *, sum(CASE WHEN twin AND p = before THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY p) AS r FROM hit),
            chosen AS (SELECT w, p, q, c FROM run QUALIFY row_number() OVER (PARTITION BY w, r ORDER BY p) % 2 = 1)
       SELECT step + 1, s.w, s.p, coalesce(a.c, t) FROM s JOIN low ON s.w = low.w LEFT JOIN chosen a ON a.w = s.w AND a.p = s.p
       WHERE step < {most} AND NOT EXISTS (SELECT 1 FROM chosen b WHERE b.w = s.w AND b.q = s.p)))
    SELECT w, list(t ORDER BY p) AS x, any_value(step) AS step FROM (SELECT * FROM s QUALIFY step = max(step) OVER (PARTITION BY w)) GROUP BY w"""

DECODED = """SELECT w, ids, hex FROM (SELECT w, array_to_string(x, ' ') AS ids FROM contracted) JOIN (
      SELECT w, string_agg(v.hex, '' ORDER BY place) AS hex
      FROM (SELECT w, unnest(x) AS t, unnest(range(len(x))) AS place FROM contracted) JOIN vocabulary v ON v.id = t GROUP BY w) USING (w)"""


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class WordEncoder:
    """(ids as text, decoded bytes) of words, by recursive SQL over a table of merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_words: int = 500_000):
        import duckdb
        import numpy as np
        import regex

        merges = [
            (ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        # A token of which a merge with a lower rank can be made: its places are contracted one by one.
        late = sorted({c for left, right, rank in merges for c in (left, right) if rank < c})
        self.find = regex.compile(pattern).findall
        self.known = {word: (str(rank), token) for token, rank in ranks.items() if (word := _text(token)) is not None}
        self.first = np.array([ranks[bytes([b])] for b in range(256)], "i4")
        self.words = Generations(most_words)
        self.ranks = ranks
        self.starts = {token[:i] for token in ranks for i in range(2, len(token) + 1)}
        spill = os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")  # made when it is needed
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": spill})
        a, b, c = zip(*merges, strict=True) if merges else ((), (), ())
        for name, table in (
            ("merges", {"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "c": pa.array(c, pa.int32())}),
            ("one_by_one", {"c": pa.array(late, pa.int32())}),
            ("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in ranks])}),
        ):
            self.db.register("given", pa.table(table))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def __call__(self, parts: list[str]) -> list[tuple[str, bytes]]:
        split = list(map(self.find, parts))
        words = set().union(*split)
        new = self.words.missing(words.difference(self.known))
        known, young = self.known, self.words.young
        brief, cut = {}, {}
        for w in new:
            raw = w.encode()
            if len(raw) < LONG_WORD:
                brief[w] = raw
            else:
                cut[w] = self._cut(raw)
        for some in _bounded(list(brief.items())):
            names, raws = zip(*some, strict=True)
            young.update(zip(names, self._contract(raws, LEFTMOST, LONG_WORD), strict=True))
        made: dict[bytes, tuple[str, bytes]] = {}
        pieces = list({piece: piece for x in cut.values() for piece in x}.items())
        for long, steps in ((False, LEFTMOST), (True, ALL_PLACES)):
            for some in _bounded([x for x in pieces if (len(x[1]) >= LONG_WORD) == long]):
                raws = [raw for _, raw in some]
                most = max(1, ROWS_AT_ONCE // sum(map(len, raws)) - 1) if long else LONG_WORD
                made.update(zip(raws, self._contract(raws, steps, most), strict=True))
        for w, x in cut.items():
            young[w] = (" ".join([made[piece][0] for piece in x]), b"".join([made[piece][1] for piece in x]))
        out = []
        for found in split:
            if len(found) == 1:
                out.append(known.get(found[0]) or young[found[0]])
                continue
            values = [known.get(w) or young[w] for w in found]
            out.append((" ".join([v[0] for v in values]), b"".join([v[1] for v in values])))
        return out

    def _cut(self, word: bytes) -> list[bytes]:
        """The word in parts that no merge crosses; a short word is one part."""
        if len(word) < LONG_WORD:
            return [word]
        ranks, starts, out, start, reach = self.ranks, self.starts, [], 0, 1
        for i in range(len(word)):
            if i >= reach:
                out.append(word[start:i])
                start = i
            stop = i + 2
            while stop <= len(word) and (token := word[i:stop]) in starts:
                if stop > reach and token in ranks:
                    reach = stop
                stop += 1
            reach = max(reach, i + 1)
        return [*out, word[start:]]

    def _contract(self, words: Sequence[bytes], steps: str, most: int) -> list[tuple[str, bytes]]:
        import numpy as np

        ends = np.concatenate([[0], np.cumsum([len(r) for r in words])]).astype("i4")
        tokens = self.first[np.frombuffer(b"".join(words), "u1")]
        left = pa.table({"w": np.arange(len(words), dtype="i4"), "x": pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))})
        done = []
        while left.num_rows:
            self.db.register("words_in_bytes", left)
            now = self.db.sql(steps.format(most=most)).to_arrow_table()
            self.db.unregister("words_in_bytes")
            finished = pa.compute.less(now["step"], most)
            done.append(now.filter(finished).select(["w", "x"]))
            left = now.filter(pa.compute.invert(finished)).select(["w", "x"])
        self.db.register("contracted", pa.concat_tables(done))
        out: list = [None] * len(words)
        found = self.db.sql(DECODED).to_arrow_table()
        for w, ids, decoded in zip(*(found.column(c).to_pylist() for c in ("w", "ids", "hex")), strict=True):
            out[w] = (ids, bytes.fromhex(decoded))
        self.db.unregister("contracted")
        return out


def _bounded(words: list[tuple[str | bytes, bytes]]) -> Iterator[list[tuple[str | bytes, bytes]]]:
    """Words, each with its bytes, as many at a time as one recursion takes."""
    some: list[tuple[str | bytes, bytes]] = []
    held = 0
    for word in words:
        size = len(word[1])
        if some and (len(some) == WORDS_AT_ONCE or held + size > BYTES_AT_ONCE):
            yield some
            some, held = [], 0
        some.append(word)
        held += size
    if some:
        yield some


def _text(token: bytes) -> str | None:
    try:
        return token.decode()
    except UnicodeDecodeError:
        return None


def _encoder(path: str, pattern: str) -> PartCache:
    """One per worker process."""
    return common.kept(("bpe", path, pattern), lambda: PartCache(WordEncoder(ranks_of(path), pattern), most=300_000))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (decimal ids joined by spaces), n_tokens, and `decoded`, the bytes that the ids stand for."""
    path, pattern = path or vocabulary_path(), pattern or vocabulary_pattern()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        cache = _encoder(path, pattern)
        for whole in batches:
            for batch in common.pieces_of(whole, "t", SLICE):
                texts = [t or "" for t in batch.column("t").to_pylist()]
                cache.prepare(texts)
                ids, decoded = [], []
                for t in texts:
                    of_parts, raws = zip(*cache.of(t), strict=True)
                    ids.append(" ".join(filter(None, of_parts)))
                    decoded.append(b"".join(raws))
                counts = [x.count(" ") + 1 if x else 0 for x in ids]
                columns = [batch.column("k"), pa.array(ids, pa.string()), pa.array(counts, pa.int64()), pa.array(decoded, pa.binary())]
                yield pa.record_batch(columns, ["doc_id", "ids", "n_tokens", "decoded"])
            common.release_memory()

    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return slim.mapInArrow(run, f"doc_id {kind}, ids string, n_tokens long, decoded binary")


@query("op2_byte_bpe")
def op2_byte_bpe(spark, folder):
    encoded = encode(common.read(spark, folder, "documents"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
