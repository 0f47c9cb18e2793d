"""Operator 1: token counts with a whole-token shortcut.

Most pre-tokens of a text are vocabulary entries. For each entry it is proved once, before the data are
read, whether the tokenizer encodes that string alone as exactly one token; a pre-token equal to such a
string counts one and never reaches the merges. Only the other pre-tokens are merged, each distinct one
once per worker while the bounded memo holds it."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounded_batches, slices
from .pretokens import as_letters, letter_bytes, pretokens, tokenizers_classes

#: Distinct merged pre-tokens that a worker remembers.
MEMO = 400_000


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def special_strings(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes as one token wherever they stand in a text."""
    return tuple(sorted((t.content for t in _tokenizer(path).get_added_tokens_decoder().values()), key=lambda s: (-len(s), s)))


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that, encoded alone, give exactly one token (the proof: encode each of them)."""
    tok, letters, special = _tokenizer(path), letter_bytes(), set(special_strings(path))
    strings = []
    for entry in tok.get_vocab(with_added_tokens=False):
        if entry in special or not all(c in letters for c in entry):
            continue
        try:
            strings.append(bytes(letters[c] for c in entry).decode())
        except UnicodeDecodeError:
            continue  # part of a character: no text can hold it as a pre-token of its own
    encoded = tok.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1)


class Counter:
    """Counts the tokens of texts; special strings inside a text are one token each, as the library has it."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.model, self.special = _tokenizer(path).model, special_strings(path)
        self.whole, self.seen = whole, dict.fromkeys(whole, 1)

    def _merged(self, piece: str) -> int:
        n = len(self.model.tokenize(as_letters(piece)))
        if len(self.seen) - len(self.whole) >= MEMO:
            self.seen = dict.fromkeys(self.whole, 1)
        if len(piece) < 200:
            self.seen[piece] = n
        return n

    def count(self, text: str) -> int:
        parts, n = [text], 0
        for s in self.special:
            if s in text:
                parts = [p for part in parts for p in part.split(s)]
        n = len(parts) - 1
        for part in parts:
            pieces = pretokens(part, tokenizers_classes)
            found = list(map(self.seen.get, pieces))
            if None in found:
                found = [self._merged(p) if k is None else k for p, k in zip(pieces, found, strict=True)]
            n += sum(found)
        return n


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, limit: int = 1024) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty (0 bytes, 0 tokens); rows are kept as they are, repeated ones and null ids
    included; an empty table gives an empty result. Other columns are not read. No shuffle."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    bounded_batches(spark)
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # at most the vocabulary

    def count(batches):
        counter = Counter(path, whole.value)
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
