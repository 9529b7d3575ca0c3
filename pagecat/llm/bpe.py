"""BPE encoding by dynamic programming over prefixes, and decoding.

A prefix of a word has exactly one encoding, so it has one last token. The automaton of the vocabulary
(a trie with suffix links) lists the tokens that end at each place, longest first; the first one that
may stand after the last token of the prefix before it is the last token of this prefix. Whether two
tokens may be neighbours is decided from the merges alone. Following the last tokens back from the end
of the word gives its ids.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecat.llm.common import by_bytes, id_text

# Words remembered by a Python worker, in two generations (results don't depend on it).
REMEMBERED = 250_000
LONG_WORD = 64
NEVER = 1 << 60


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in out)
    out.update({b: chr(256 + k) for k, b in enumerate(hidden)})
    return [out[b] for b in range(256)]


class WordBpe:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE vocabulary")
        if spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("decoders and post processors are not handled")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self._read_text_steps(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._read_merges(model["merges"])
        self._build_automaton()
        self.table = {b: c for b, c in enumerate(byte_characters())}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.word_known: dict[str, array] = {}

    def _read_text_steps(self, spec: dict) -> None:
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["content"] != " ":
            raise ValueError("other normalisation than NFC, white space, lower case")
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("other splitting than one pattern whose matches are words")
        self.words = regex.compile(split["pattern"]["Regex"])

    def _read_merges(self, merges: list) -> None:
        """Rank of every pair, and the two parts and birth rank of every merged token."""
        self.rank: dict[tuple[int, int], int] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        for k, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank.setdefault((x, y), k)
            if z not in self.born:
                self.born[z], self.left[z], self.right[z] = k, x, y

    def _build_automaton(self) -> None:
        """A trie of all tokens; at each node its token, its suffix link, and its next shorter token."""
        self.next: dict[tuple[int, str], int] = {}
        parent, depth, symbol_of, token = [0], [0], [""], [-1]
        for text, i in self.ids.items():
            at = 0
            for symbol in self.symbols(text):
                to = self.next.get((at, symbol))
                if to is None:
                    to = self.next[at, symbol] = len(parent)
                    parent.append(at)
                    depth.append(depth[at] + 1)
                    symbol_of.append(symbol)
                    token.append(-1)
                at = to
            token[at] = i
        link, shorter = [0] * len(parent), [0] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if depth[node] > 1:
                at = link[parent[node]]
                while (at, symbol_of[node]) not in self.next and at:
                    at = link[at]
                link[node] = self.next.get((at, symbol_of[node]), 0)
            shorter[node] = link[node] if token[link[node]] >= 0 else shorter[link[node]]
        self.token, self.link, self.shorter, self.depth = token, link, shorter, depth

    def symbols(self, text: str) -> list[str]:
        """Symbols of a token or word: characters, the last one with the word end if there is one."""
        if self.suffix and text.endswith(self.suffix) and len(text) > len(self.suffix):
            body = text[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(text)

    def neighbours(self, a: int, b: int) -> bool:
        """Whether an encoding may hold token a right before token b.

        Replays the merges at the place between them in order of rank: along the right edge of a and the
        left edge of b, from single symbols up. If a pair across the place would have merged before
        either side's own next merge (on a tie, the leftmost goes first), a and b can't be neighbours.
        """
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) > REMEMBERED:
                self.compatible.clear()
            edge_a, edge_b = [a], [b]
            while edge_a[-1] in self.born:
                edge_a.append(self.right[edge_a[-1]])
            while edge_b[-1] in self.born:
                edge_b.append(self.left[edge_b[-1]])
            known = True
            x, y = len(edge_a) - 1, len(edge_b) - 1
            while True:
                next_a = self.born[edge_a[x - 1]] if x else NEVER
                next_b = self.born[edge_b[y - 1]] if y else NEVER
                across = self.rank.get((edge_a[x], edge_b[y]), NEVER)
                if across < next_a and across <= next_b and across < NEVER:
                    known = False
                    break
                if next_a == next_b == NEVER:
                    break
                if next_a <= next_b:
                    x -= 1
                else:
                    y -= 1
            self.compatible[a, b] = known
        return known

    def encode_symbols(self, symbols: list[str]) -> list[int]:
        """Ids of a word from the unique last token of each of its prefixes."""
        last: list[int] = []
        before: list[int] = []
        at = 0
        following, link, token, shorter, depth = self.next, self.link, self.token, self.shorter, self.depth
        compatible, neighbours = self.compatible, self.neighbours
        for end, symbol in enumerate(symbols):
            while (to := following.get((at, symbol))) is None and at:
                at = link[at]
            at = to or 0
            node = at if token[at] >= 0 else shorter[at]
            while node:
                start = end - depth[node]
                if start < 0:
                    break
                pair = last[start], token[node]
                fits = compatible.get(pair)
                if fits or (fits is None and pair[0] >= 0 and neighbours(*pair)):
                    break
                node = shorter[node]
            last.append(token[node] if node else -1)
            before.append(end - depth[node] if node else -2)
        out = []
        end = len(symbols) - 1
        while end >= 0:
            if last[end] < 0:
                raise ValueError("a word can't be written with this vocabulary")
            out.append(last[end])
            end = before[end]
        return out[::-1]

    def word_ids(self, word: str) -> array:
        """Ids of one word of the splitting pattern."""
        return array("I", self.encode_symbols(self.symbols("".join(map(self.table.__getitem__, word.encode())) + self.suffix)))

    def normalised(self, text: str) -> str:
        """NFC and lower case, character by character (no final sigma rule)."""
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def part_ids(self, part: str) -> array:
        """Ids of a text between two spaces, all its words in order."""
        ids = self.older.get(part)
        if ids is None:
            ids = array("I")
            for word in self.words.findall(self.normalised(part)):
                found = self.word_known.get(word) or self.word_ids(word)
                ids += found
                if len(word) <= LONG_WORD:
                    if len(self.word_known) >= REMEMBERED:
                        self.word_known.clear()
                    self.word_known[word] = found
        if len(part) <= LONG_WORD:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[part] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a text; special tokens inside the text become their own ids.

        No word crosses white space and nothing composes with it, so a text is the sum of its parts
        between spaces and line ends.
        """
        out = array("I")
        if not text:
            return out
        begin = 0
        spots = [(m.start(), m.end()) for m in self.specials.finditer(text)] if self.specials else []
        for start, end in [*spots, (len(text), len(text))]:
            for part in text[begin:start].replace("\n", " ").split(" "):
                out += self.known.get(part) or self.part_ids(part)
            if end > start:
                out.append(self.special[text[start:end]])
            begin = end
        return out

    def decode(self, ids: array) -> str:
        """Tokens joined by spaces, as there is no decoder; special tokens are kept."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def vocabulary(path: str) -> WordBpe:
    """One per Python worker."""
    return WordBpe(path)


def little_endian(ids: array) -> bytes:
    if array("I").itemsize != 4:
        raise ValueError("ids need 32 bits here")
    if sys.byteorder == "big":
        ids = ids[:]
        ids.byteswap()
    return ids.tobytes()


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and its ids if asked for.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows give repeated rows, an empty
    table an empty one; other columns are not read.
    """
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(tokenizer)

        def work(ids: list, texts: list) -> pa.RecordBatch:
            found = [model.encode(t) for t in texts]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(list(map(len, found)), pa.int64()),
                pa.array([hashlib.sha256(little_endian(x)).hexdigest() for x in found], pa.string()),
                pa.array([hashlib.sha256(model.decode(x).encode()).hexdigest() for x in found], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = np.concatenate([np.empty(0, np.uint32), *(np.frombuffer(x, np.uint32) for x in found)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        return by_bytes(batches, work, 2 << 20)

    return id_text(docs, id_col, text_col).mapInArrow(run, kind)


def decoded(rows: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every row of ids; null ids count as none and give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(tokenizer)
        for batch in batches:
            texts = [model.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )
