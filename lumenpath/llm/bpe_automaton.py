"""BPE encoding and decoding with a deterministic automaton compiled from the merge list.

The automaton reads tokens. It starts as one state that accepts every sequence over the
base alphabet. For each merge (u, v) -> w in order, a gadget is applied: the state reached
by u is split, the copy loses its v arc, and w arcs are added wherever u could be read,
leading to the state that v led to. After the last merge it accepts exactly the correct
tokenizations, so each prefix of a word has one accepted tokenization at most, and
following arcs from left to right encodes. Every arc carries its token's text as label;
decoding emits the labels.

States are kept as differences (parent state, removed token, time of the merge), because
each gadget changes one arc; the explicit table of visited transitions is filled on demand.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.chunk_table import PASS_CHARS, ChunkTable
from lumenpath.llm.common import held, map_texts, texts_of

# The split pattern of the vocabulary file.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: These separate for str.split but are no white space for the vocabulary's pattern.
SEPARATORS = re.compile("[\x1c-\x1f]")
END = "</w>"
#: Texts whose ids and decoded texts are made at once have about so many characters: all that lies in memory beside the tables is of their size.
ROW_CHARS = 250_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Automaton:
    """The compiled automaton: arcs by token id, states by number."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.label = {i: t for t, i in self.vocab.items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.label.update({i: t for t, i in self.added.items()})
        self.root: dict = {}
        for text, i in self.vocab.items():
            symbols = [*text[: -len(END) - 1], text[-len(END) - 1 :]] if text.endswith(END) and text != END else text
            below = self.root
            for x in symbols:
                arc = below.setdefault(x, [{}, None])
                below = arc[0]
            arc[1] = i
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.parent, self.removed, self.time = [-1], [-1], [-1]
        self.target = dict.fromkeys(self.vocab.values(), 0)
        self.left: dict[int, int] = {}
        self.born: dict[int, int] = {}
        for k, (u, v) in enumerate(merges):
            self._gadget(k, self.vocab[u], self.vocab[v], self.vocab[u + v])
        self.lacks: dict[int, dict[int, int]] = {}
        self.table: dict[int, int] = {}

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        after = self.target[v]
        self.parent.append(self.target[u])
        self.removed.append(v)
        self.time.append(k)
        self.target[u] = len(self.parent) - 1
        self.target[w], self.left[w], self.born[w] = after, u, k

    def _lost(self, state: int) -> dict[int, int]:
        """Token -> time of the first merge that took its arc from the state."""
        lost = self.lacks.get(state)
        if lost is None:
            lost, s = {}, state
            while s > 0:
                lost[self.removed[s]] = min(self.time[s], lost.get(self.removed[s], self.time[s]))
                s = self.parent[s]
            self.lacks[state] = lost
        return lost

    def step(self, state: int, token: int) -> int:
        """The state after reading ``token``, or -1 if the state has no such arc.

        A merged token's arc was made where its left part's arc stood, so an arc is missing
        if it was removed, or its left part's was before the merge, and so on down.
        """
        found = self.table.get(state << 32 | token)
        if found is None:
            lost, x, before, found = self._lost(state), token, len(self.parent), self.target[token]
            while True:
                t = lost.get(x)
                if t is not None and t <= before:
                    found = -1
                    break
                if x not in self.left:
                    break
                before, x = self.born[x], self.left[x]
            if len(self.table) > 400_000:
                self.table.clear()
            self.table[state << 32 | token] = found
        return found

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-split word, given in byte characters without its end mark.

        Follows the longest arc first. A position that is left by no accepted path is dead
        for good, since at most one tokenization of each prefix is accepted: every position
        is left once at most, so the work grows with the word's length.
        """
        symbols = [*word[:-1], word[-1] + END]
        n, table, dead = len(symbols), self.table, set()
        pos, state, arcs, path, out = 0, 0, self._arcs(symbols, 0, n), [], []
        while pos < n:
            while arcs:
                token, end = arcs.pop()
                if end in dead:
                    continue
                to = table.get(state << 32 | token)
                if to is None:
                    to = self.step(state, token)
                if to >= 0:
                    path.append((pos, state, arcs))
                    out.append(token)
                    pos, state, arcs = end, to, self._arcs(symbols, end, n)
                    break
            else:
                dead.add(pos)
                pos, state, arcs = path.pop()
                out.pop()
        return out

    def _arcs(self, symbols: list[str], at: int, n: int) -> list[tuple[int, int]]:
        """(token, end) of the tokens whose text starts at ``at``, shortest first."""
        below, found = self.root, []
        while at < n:
            arc = below.get(symbols[at])
            if arc is None:
                break
            at += 1
            below, token = arc
            if token is not None:
                found.append((token, at))
        return found

    def decode(self, ids) -> str:
        """Labels of the arcs; the file has no decoder, so labels are joined by a space, as the library does."""
        return " ".join(self.label[i] for i in ids)


def pieces(text: str, added: list[str]) -> list[tuple[bool, str]]:
    """(is an added token, piece): added tokens' strings in a text are tokens by the library's default."""
    if added and any(a in text for a in added):
        cut = re.split("(" + "|".join(map(re.escape, added)) + ")", text)
        return [(i % 2 == 1, p) for i, p in enumerate(cut) if p]
    return [(False, text)]


def words(chunk: str) -> list[str]:
    """Normalise one chunk (NFC, lower case by character) and split it into words."""
    if chunk.isascii():
        chunk = chunk.lower()
        if chunk.isalpha():
            return [chunk]
        if len(chunk) > 1 and chunk[:-1].isalpha() and not chunk[-1].isalnum():
            return [chunk[:-1], chunk[-1]]
    else:
        chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
    return WORDS.findall(chunk)


def in_byte_characters(word: str, shown: list[str]) -> str:
    """Each byte of a word as its printable character."""
    return word if word.isascii() and word.isprintable() else "".join(map(shown.__getitem__, word.encode()))


class Encoder:
    """Whole texts to ids and back over one automaton, remembering chunks and words in bounded memory."""

    def __init__(self, automaton: Automaton) -> None:
        shown, added = byte_characters(), list(automaton.added)
        self.auto = automaton
        self.table = ChunkTable(lambda w: automaton.encode_word(in_byte_characters(w, shown)), words, lambda t: pieces(t, added), automaton.added)
        self.labels = pa.array([automaton.label.get(i, "") for i in range(max(automaton.label) + 1)])

    def encode(self, text: str) -> list[int]:
        return self.table.encode([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """(ids, decoded text) of each text; the arcs' labels are joined by a space, as the library does."""
        ids, offsets = self.table.encode(texts)
        offsets = pa.array(offsets, pa.int32())
        labels = self.labels.take(pa.array(ids, pa.uint32()))
        return pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32))), pc.binary_join(pa.ListArray.from_arrays(offsets, labels), " ")


def compile_file(path: str) -> dict:
    """The parts of a vocabulary file that the automaton needs. Its size is fixed by the vocabulary."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return {"model": {k: spec["model"][k] for k in ("vocab", "merges")}, "added_tokens": [{k: a[k] for k in ("id", "content")} for a in spec["added_tokens"]]}


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns per row ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``full``, also
    ``ids`` (array<int>) and ``decoded``. Null and empty texts have no tokens and an empty
    decoded text; repeated rows are each encoded; no row is dropped; an empty table stays
    empty; extra columns are ignored. A narrow map: no shuffle, and memory per task is one
    batch of texts, the automaton (size fixed by the vocabulary) and tables bounded by bytes.
    """
    spec = docs.sparkSession.sparkContext.broadcast(compile_file(vocab_path))

    def start():
        return held(f"automaton {vocab_path}", lambda: Encoder(Automaton(spec.value))).encode_all

    names = [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    said = map_texts(texts_of(docs, id_col, text_col), "doc_id long, ids array<int>, decoded string", names, None, start, min(PASS_CHARS, ROW_CHARS))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    ids = digest(F.array_join(F.col("ids").cast("array<string>"), " "))
    return said.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"), *(["ids", "decoded"] if full else []))
