"""Token counts: batch encoding inside Arrow functions, lengths only.

A sentence-piece text turns each space into a mark that can only stand at the start of a vocabulary
entry (or in a run of marks). So no merge crosses the place between a character that is no space and a
single space, and the tokens of a text are those of its parts cut there: every part gets the mark
back as the encoder's own dummy prefix. Long texts are cut at these places, equal parts are
encoded once per batch, and batches are balanced by bytes.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from pagecat.llm.common import by_bytes, id_text

MARK = "▁"
_SAFE = re.compile(f"(?<=[^ {MARK}])[ {MARK}](?=[^ {MARK}])")
# Parts remembered by a Python worker; beyond it the memory starts anew (results don't change).
REMEMBERED = 300_000
# Likewise of parts remembered with their ids, about 0.2 KB each.
REMEMBERED_IDS = 800_000
# Parts longer than this are encoded, but not remembered.
LONG_PART = 64


@lru_cache(maxsize=2)
def piece_encoder(path: str):
    """The encoder of a vocabulary file, once per Python worker; checks that cutting is safe."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece has a mark inside: texts can't be cut at spaces")
    return model


def safe_parts(text: str) -> list[str]:
    """Parts of a text whose tokens, each with the dummy prefix, are the tokens of the text."""
    if not text:
        return []
    if MARK not in text:
        parts = text.split(" ")
        if "" not in parts:
            return parts
    return _SAFE.split(text)


@lru_cache(maxsize=2)
def _ids(path: str) -> tuple[dict[str, bytes], list[str]]:
    return {}, []


def part_ids(path: str, texts: list[list[str]]) -> dict[str, bytes]:
    """Token ids (as bytes, 16 bits each) of at least every part of some texts; parts not yet known are one batch."""
    model, (known, long) = piece_encoder(path), _ids(path)
    for p in long:
        known.pop(p, None)
    long.clear()
    if len(known) > REMEMBERED_IDS:
        known.clear()
    fresh = list(set(chain.from_iterable(texts)).difference(known))
    known.update(zip(fresh, (array("H", i).tobytes() for i in model.encode(fresh, num_threads=1))))
    long += [p for p in fresh if len(p) > LONG_PART]
    return known


@lru_cache(maxsize=2)
def _lengths(path: str) -> dict[str, int]:
    return {}


def lengths(path: str, texts: list[str | None]) -> list[int]:
    """Tokens of each text."""
    model = piece_encoder(path)
    known = _lengths(path)
    if len(known) > REMEMBERED:
        known.clear()
    parts = [safe_parts(t) if t else [] for t in texts]
    fresh = list({p for text in parts for p in text}.difference(known))
    sizes = {}
    for start in range(0, len(fresh), 20_000):
        some = fresh[start : start + 20_000]
        sizes.update(zip(some, map(len, model.encode(some, num_threads=1))))
    known.update(sizes)
    get = known.__getitem__
    out = [sum(map(get, text)) for text in parts]
    for p in sizes:
        if len(p) > LONG_PART:
            del known[p]
    return out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows; an empty table
    gives an empty table; other columns are not read. ``tokenizer`` is the path of a sentence-piece
    model that every executor can open.
    """

    def work(ids: list, texts: list) -> pa.RecordBatch:
        n = lengths(tokenizer, texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_()),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_bytes(batches, work)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
