"""BPE encoding by a deterministic automaton over tokens; decoding by emitting its arc labels.

The automaton accepts exactly the token sequences that merging in rank order can produce. It starts with one state and a loop
for every symbol. Merge number k of (u, v) attaches a gadget: the arc u now leads to a new state that copies u's old target
but has no arc v, and every state with an arc u gets an arc uv to where v led. Each token therefore has one target state, and
a state differs from the start only by arcs taken away, each at a known merge. These few facts are the table; arcs out of a
state are worked out from them on first use and remembered. Every prefix of a word has exactly one accepted reading, so
one left-to-right pass over a word finds its tokens; no merge loop runs.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from medloom.llm.cluster import free_name

# Words and arcs remembered by one Python worker; a full memory of words is kept until the next one is full, that of arcs starts anew.
MOST_WORDS = 120_000
MOST_ARCS = 500_000
# Characters whose class, case and composition are the same in all Unicode versions in use: Latin, Cyrillic without the dotted
# capital I, general punctuation, kana, common Han, Hangul.
SETTLED = regex.compile("[\\x00-\\x1b -\u012f\u0131-\u02af\u0400-\u0482\u048a-\u04ff\u2010-\u2027\u2030-\u205e\u3000-\u3020\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return [chr(b) if b in set(plain) else chr(256 + k) for b, k in _numbered(plain, rest)]


def _numbered(plain: list[int], rest: Iterator[int]) -> list[tuple[int, int]]:
    place = {b: k for k, b in enumerate(rest)}
    return [(b, place.get(b, 0)) for b in range(256)]


class Automaton:
    """Token automaton of a merge list. Tokens are ids; ``vocab`` maps strings to them.

    A merge whose parts never stand side by side when its turn comes makes no gadget, and a token that no merge produces is
    never read. A merge listed before those that make its parts has no place in the order and raises ValueError.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.longest = max((len(t) - (len(suffix) if suffix and t.endswith(suffix) else 0) for t in vocab), default=1)
        self.symbols = {t for t in vocab if len(t) == 1}
        # what merging can produce; vocabulary entries beyond that have no arc
        self.tokens = {t: i for t, i in vocab.items() if len(t) == 1 or (suffix and t[1:] == suffix)}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.removed: dict[int, dict[int, int]] = {}
        early: list[tuple[int, str, str]] = []
        last = {pair: rank for rank, pair in enumerate(merges)}  # a repeated pair has its later rank
        for rank, (u, v) in enumerate(merges):
            if last[u, v] != rank:
                continue
            if u not in self.tokens or v not in self.tokens:
                early.append((rank, u, v))
            elif u + v in vocab and self._arc(self.tokens[u], self.tokens[v]):
                self._gadget(rank, self.tokens[u], self.tokens[v], vocab[u + v])
                self.tokens[u + v] = vocab[u + v]
        for rank, u, v in early:
            if u in self.tokens and v in self.tokens and u + v in vocab:
                raise ValueError(f"merge {rank} ({u} {v}) stands before the merges of its parts")
        self.arcs: dict[int, bool] = {}

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        # the arc uv leads where v led so far, before u's own target loses v; the arcs lost there are looked up along ``right``
        self.left[uv], self.right[uv], self.born[uv] = u, v, rank
        self.removed.setdefault(u, {}).setdefault(v, rank)

    def _lost(self, u: int, t: int) -> int | None:
        """The first merge at which the target state of u lost the arc t: its own losses, and those it was born with."""
        first, until = None, 1 << 60
        while True:
            own = self.removed.get(u)
            if own is not None:
                rank = own.get(t)
                if rank is not None and rank < until:
                    first = rank
            if u not in self.right:
                return first
            until = self.born[u]
            u = self.right[u]

    def follows(self, u: int, t: int) -> bool:
        """Whether the target state of u has an arc t."""
        key = u << 32 | t
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= MOST_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._arc(u, t)
        return known

    def _arc(self, u: int, t: int) -> bool:
        """t has an arc unless it, or the left part it was made from, was gone when it was made."""
        until = 1 << 60
        while True:
            lost = self._lost(u, t)
            if lost is not None and lost <= until:
                return False
            if t not in self.left:
                return True
            until = self.born[t]
            t = self.left[t]

    def encode(self, symbols: str) -> list[int]:
        """Tokens of one pre-split word.

        Takes the longest arc the current state has; where none leads on, the place is dead (a prefix has one reading, so no
        other way reaches it) and the last arc is replaced by a shorter one. Symbols outside the vocabulary are left out, as a
        model without an unknown token does.
        """
        vocab, suffix, follows, longest = self.tokens, self.suffix, self.follows, self.longest
        if suffix and symbols and symbols[-1] + suffix not in vocab:
            suffix, symbols = "", symbols[:-1]
        if not all(map(self.symbols.__contains__, symbols)):
            symbols = "".join([c for c in symbols if c in self.symbols])
        n = len(symbols)
        whole = vocab.get(symbols + suffix)  # the start state has every arc
        if whole is not None:
            return [whole]
        out: list[int] = []
        ends = [0]
        dead: set[int] = set()
        at, to = 0, min(n, longest)
        while at < n:
            while to > at:
                if to not in dead:
                    token = vocab.get(symbols[at:to] + suffix if to == n else symbols[at:to])
                    if token is not None and (at == 0 or follows(out[-1], token)):
                        break
                to -= 1
            if to > at:
                out.append(token)
                ends.append(to)
                at, to = to, min(n, to + longest)
            else:
                dead.add(at)
                out.pop()
                to = ends.pop() - 1
                at = ends[-1]
        return out


class _Memory(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict = {}

    def __missing__(self, word):
        value = self.old.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(self) >= MOST_WORDS:
            # the words before these go, those in use come back from here
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


class Tokenizer:
    """A byte-level BPE file with word ends: normalises, splits, encodes and decodes.

    Texts of added tokens are found first, left to right, and become one id each; the rest is composed (NFC), letters are
    lowered, and matches of the split pattern, which never hold white space, are encoded on their own.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.labels = {i: t for t, i in model["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split, regex.V0)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.alphabet = byte_alphabet()
        self.words = _Memory(self._word)
        self.pieces = _Memory(self._piece)
        self.path = path

    @functools.cached_property
    def library(self) -> tokenizers.Tokenizer:
        """Read only where a text has rarer scripts, as it holds the vocabulary a second time."""
        return tokenizers.Tokenizer.from_file(self.path)

    def _word(self, word: str) -> bytes:
        return self._piece("".join([self.alphabet[b] for b in word.encode("utf-8")]))

    def _piece(self, symbols: str) -> bytes:
        return np.array(self.automaton.encode(symbols), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        if SETTLED.fullmatch(text) is None:
            # rarer scripts: their letters depend on the Unicode version, so the library normalises and pre-splits
            parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([self.pieces[p] for p, _ in parts])
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        return b"".join(map(self.words.__getitem__, self.split.findall(text.lower())))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.added[m.group()]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    @functools.cached_property
    def _label_list(self) -> list[str]:
        return [self.labels.get(i, "") for i in range(max(self.labels, default=-1) + 1)]

    def decode(self, ids: bytes) -> str:
        """Labels of the ids, one space between them (the file names no decoder)."""
        labels = self._label_list
        return " ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in short pieces, so that only a few results are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """One per Python worker and file."""
    return Tokenizer(path)


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens and ids (binary, unsigned 32-bit little-endian) for every row; null text is empty.

    Kept columns named n_tokens or ids are replaced, others pass through. Repeated rows encode alike, a very long text is read
    whole, and an empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name in keep and f.name.lower() not in ("n_tokens", "ids")]
    own = free_name(docs, "_text")
    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        names = [f.name for f in fields]
        for batch in _slices(batches):
            ids = [t.encode(x.as_py()) for x in batch.column(own)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), counts, pa.array(ids, pa.binary())], [*names, "n_tokens", "ids"]
            )

    return docs.select(*[docs[f.name] for f in fields], docs["text"].alias(own)).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``text``, the labels of ``ids``; null ids are none. A ``text`` column is replaced."""
    encoded = encoded.drop("text")
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            texts = pa.array([t.decode(x.as_py() or b"") for x in batch.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``decode(encode(docs))`` with one tokenizer a worker. Kept columns named n_tokens, ids or text are replaced."""
    fields = [f for f in docs.schema.fields if f.name in keep and f.name.lower() not in ("n_tokens", "ids", "text")]
    own = free_name(docs, "_text")
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in _slices(batches):
            ids = [t.encode(x.as_py()) for x in batch.column(own)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            texts = pa.array([t.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), counts, pa.array(ids, pa.binary()), texts], [*names, "n_tokens", "ids", "text"]
            )

    return docs.select(*[docs[n] for n in names], docs["text"].alias(own)).mapInArrow(run, T.StructType([*fields, *more]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, and keep only the digests."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for x in batch.column("text"):
                ids = t.encode(x.as_py())
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(t.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
