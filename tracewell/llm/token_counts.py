"""Token counts of whole texts, without merging what a table already knows to be one token.

Which strings of the vocabulary encode alone as one token is proved once per worker: a string is such a token if the merge
table, applied to its characters and nothing else, ends in it.  A text is cut at white space, a part into the pieces that
the vocabulary's own splitter makes; a piece among the proved strings counts one, and only the other pieces are
merged.  Parts repeat, so most counts come from a bounded memory.

Where the splitting is plain (printable ASCII) it is done here; any other part goes through the normaliser and splitter of
the file itself.  The file's added tokens are cut out of a text first, as the library does, and count one.

Defined cases: a null text is the empty one, which has no token (`n_bytes` 0).  Texts of any length are counted whole.
A repeated row is counted again, a null id stays null, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.registry import query
from tracewell.llm.tokens import Generations

LIMIT = 2048
SLICE = 4 << 20  # bytes of text that are counted at once
REMEMBERED, LONGEST = 400_000, 64  # parts that are remembered, and how long one may be

# The splitter of the vocabulary file on printable ASCII without capitals.  Fixed value.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
# White space that surely separates parts.  Other white space is left to the file's own normaliser.
BREAKS = str.maketrans("\t\n\r", "   ")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Counter:
    """Counts tokens by one vocabulary file: byte-level BPE over lower-cased pieces with a mark at the end of a piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = spec["added_tokens"]
        for t in added:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["content"]:
                raise ValueError(f"an added token of another kind: {t}")
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))) or r"(?!)")
        self.tokens = Tokenizer.from_file(path)
        self.end = spec["model"]["end_of_word_suffix"]
        self.whole = self._proved(spec["model"]["vocab"])
        self.parts, self.pieces = Generations(REMEMBERED), Generations(REMEMBERED)

    def _proved(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """The pieces that the merge table makes one token of."""
        ends = (t[: -len(self.end)] for t in vocabulary if t.endswith(self.end) and t != self.end)
        merge = self.tokens.model.tokenize
        return frozenset(piece for piece in ends if len(merge(piece)) == 1)

    def _merged(self, piece: str) -> int:
        return len(self.tokens.model.tokenize(piece))

    def _split(self, part: str) -> list[str]:
        if part.isascii() and part.isprintable():
            return PIECES.findall(part.lower())
        # A part of white space alone becomes nothing here, as in a text.
        return [p for p, _ in self.tokens.pre_tokenizer.pre_tokenize_str(self.tokens.normalizer.normalize_str(part))]

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        cut = [self.added.split(t) if "<|" in t else [t] for t in texts]
        split = [[part for run in runs for part in run.translate(BREAKS).split(" ")] for runs in cut]
        new = self.parts.missing({part for parts in split for part in parts})
        pieces = {part: self._split(part) for part in new}
        rest = self.pieces.missing({p for made in pieces.values() for p in made if p not in self.whole})
        sizes = self.pieces.young
        sizes.update((p, self._merged(p)) for p in rest)
        known, whole = self.parts.young, self.whole
        known.update((part, sum(1 if p in whole else sizes[p] for p in made)) for part, made in pieces.items())
        found = [len(runs) - 1 + sum(map(known.__getitem__, parts)) for runs, parts in zip(cut, split, strict=True)]
        for held, keys in ((known, new), (sizes, rest)):
            for long in [k for k in keys if len(k) > LONGEST]:
                del held[long]
        return found


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row."""
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.one_thread()
        counter = common.kept(("token counts", path), lambda: Counter(path))
        for whole in batches:
            for batch in common.pieces_of(whole, "t", SLICE):
                counts = counter.counts([t or "" for t in batch.column("t").to_pylist()])
                yield pa.record_batch([batch.column("k"), batch.column("n"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
            common.release_memory()

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), size.alias("n"))
    counted = slim.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op13_token_counts")
def op13_token_counts(spark, folder):
    return count_tokens(common.read(spark, folder, "documents"))
