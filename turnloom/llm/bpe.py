"""BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a partition are laid out as one linked row of
symbols. An index maps each adjacent pair that has a rank to all its positions.
Active ranks are applied in ascending order: all occurrences of a rank's pair
are merged, and only the lists of the pairs beside them are updated. Encoded
pre-tokens are remembered, so a partition encodes each once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the tokenizer's file format: how its words are cut out, and the mark of a word's end.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Pre-tokens remembered by a task before its table is started anew.
REMEMBERED = 1 << 17
#: Texts are cut up this many characters' worth at a time.
CHUNK_CHARS = 1 << 18


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 up, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Tokenizer:
    """A word-end BPE vocabulary read from a tokenizers JSON file's text."""

    def __init__(self, source: str):
        made = json.loads(source)
        model = made["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or model.get("unk_token") is not None:
            raise ValueError("a BPE model with word ends and without an unknown token is needed")
        self.vocabulary: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        number = self.vocabulary
        self.ranks = {(number[a], number[b]): (rank, number[a + b]) for rank, (a, b) in enumerate(merges)}
        self.pairs = [(number[a], number[b]) for a, b in merges]
        letters = byte_letters()
        self.inner = [number[c] for c in letters]
        self.final = [number[c + WORD_END] for c in letters]
        added = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.split = regex.compile(SPLIT)
        self.tokens: dict[int, str] = {v: k for k, v in self.vocabulary.items()} | {v: k for k, v in added.items()}
        self.specials = {k: v.to_bytes(4, "little") for k, v in added.items()}

    def pieces(self, text: str) -> list[str]:
        """A text's pre-tokens and added tokens, in order.

        Added tokens are found in the text as it is; what is between them is
        composed (NFC), lower-cased letter by letter and cut by the pattern.
        """
        if self.added is None or not self.added.search(text):
            return self.split.findall(_normal(text))
        out, at = [], 0
        for found in self.added.finditer(text):
            out += self.split.findall(_normal(text[at : found.start()]))
            out.append(found[0])
            at = found.end()
        return out + self.split.findall(_normal(text[at:]))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Each distinct pre-token's ids, as little-endian unsigned 32-bit integers."""
        symbols: list[int] = []
        starts = [0]
        for piece in pieces:
            raw = piece.encode()
            symbols += [self.inner[b] for b in raw[:-1]]
            symbols.append(self.final[raw[-1]])
            starts.append(len(symbols))
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        for s in starts[1:]:
            after[s - 1] = -1
        for s in starts[:-1]:
            before[s] = -1
        ranks = self.ranks
        places: defaultdict[int, list[int]] = defaultdict(list)
        for i, j in enumerate(after):
            if j >= 0 and (known := ranks.get((symbols[i], symbols[j]))):
                places[known[0]].append(i)
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right = self.pairs[rank]
            made = ranks[left, right][1]
            for i in sorted(places.pop(rank)):
                j = after[i]
                if symbols[i] != left or j < 0 or symbols[j] != right:
                    continue  # a merge to the left has taken it
                k = after[j]
                symbols[i], symbols[j], after[i] = made, -1, k
                if k >= 0:
                    before[k] = i
                for a, b in ((before[i], i), (i, k)):
                    if a >= 0 and b >= 0 and (known := ranks.get((symbols[a], symbols[b]))):
                        if known[0] not in places:
                            heapq.heappush(active, known[0])
                        places[known[0]].append(a)
        whole = np.array(symbols, np.int64)
        alive = whole >= 0
        ids = whole[alive].astype("<u4").tobytes()
        ends = (4 * np.concatenate([[0], np.cumsum(alive)])[starts]).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The ids' tokens with a space between; ids not in the vocabulary give nothing."""
        tokens = self.tokens
        return " ".join([t for i in ids.tolist() if (t := tokens.get(i)) is not None])


def _normal(text: str) -> str:
    # white space only separates, so making runs of it one space changes no pre-token
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


def _batches(texts: list[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(t or "")
        if size > CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_decode(documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), with keep_ids also ids and decoded, of every text.

    vocabulary is the path of a tokenizers JSON file, read on the driver and
    broadcast (under 2 MB). No special tokens are added, but their strings in a
    text become their ids. A null text is an empty one, without tokens. Rows are
    independent of each other; null and repeated ids are passed on.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = documents.sparkSession.sparkContext.broadcast(f.read())
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * keep_ids

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(source.value)
        known: dict[str, bytes] = dict(tokenizer.specials)
        for part in parts:
            counts, hashes, decoded, all_ids, all_texts = [], [], [], [], []
            for batch in _batches(part.column("text").to_pylist()):
                if len(known) > REMEMBERED:
                    known = dict(tokenizer.specials)
                pieces = [tokenizer.pieces(t) for t in batch]
                new = [*{p for x in pieces for p in x if p not in known}]
                known.update(zip(new, tokenizer.encode_pieces(new), strict=True))
                for x in pieces:
                    raw = b"".join(map(known.__getitem__, x))
                    ids = np.frombuffer(raw, "<u4")
                    text = tokenizer.decode(ids)
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(raw).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
                    if keep_ids:
                        all_ids.append(ids.astype(np.int64))
                        all_texts.append(text)
            columns = [part.column("id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            if keep_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int64())), pa.array(all_texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_column)
