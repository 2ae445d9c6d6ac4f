"""BPE encoding and decoding by prefix-sharing trie traversal.

Texts are cut at blanks; each distinct chunk of a slice of the input is normalised and cut into
words once.  The distinct words that no recent slice held, sorted, are a trie in depth-first order: a
word keeps the states of the prefix it shares with the word before it.  The state of a prefix is the last token of its
encoding, and follows from the states of shorter prefixes: the last token is the one suffix that is
a token and may stand after the last token of what is left.  Whether token b may stand after token
a is a question about merge ranks only (``Merges.adjacent``).

Defined results: null and empty texts have no tokens; texts of any length are encoded whole; added
tokens of the vocabulary file are found in the raw text; repeated rows are encoded each; an empty
table gives an empty result; of the input's columns only text and the kept ones play a part, and where
a kept one is named ids or decoded the new column's name ends in underscores.

The vocabulary file must be of this kind: NFC, one blank for blanks and lower case as normaliser,
``WORDS`` and byte letters as words, ``</w>`` at the end of words; ``Encoder`` refuses others.
"""

from __future__ import annotations

import functools
import gc
import json
import re
from collections.abc import Iterator
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, free_name, lean, small_batches

#: Bytes of text whose distinct words share one trie, and words of a generation: the words met last and the generation before are remembered.
SLICE_BYTES = 4 << 20
GENERATION = 140_000
END = "</w>"
#: In this and the lower blocks letters, digits, lower case and normal form are the same in all versions of the standard.
STABLE = "\u0250"
#: Marks that often end a chunk, each a word of its own there.
MARKS = frozenset(".,;:!?")
#: What Python takes for a blank and the standard does not.
ODD_BLANKS = "\x1c\x1d\x1e\x1f"
#: The split pattern and the printable stand-ins for bytes of byte-level vocabularies.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[int, str]:
    """Byte value to letter: printable ones stand for themselves, the others follow from U+0100 on."""
    shown = set(PRINTABLE)
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class _Shown(dict):
    """Byte letters of a character."""

    def __init__(self, letters: dict[int, str]):
        super().__init__()
        self.letters = letters

    def __missing__(self, c: str) -> str:
        v = self[c] = "".join([self.letters[b] for b in c.encode()])
        return v


class Merges:
    """Merge ranks of a vocabulary; a token is known by its id."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        n = max(vocab.values()) + 1
        self.rank, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.pair: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            t = vocab[a + b]
            self.pair[vocab[a], vocab[b]] = r
            self.rank[t], self.left[t], self.right[t] = r, vocab[a], vocab[b]
        self.known: dict[int, bool] = {}
        own = [True] * n
        for t in sorted(range(n), key=self.rank.__getitem__):
            if self.rank[t] >= 0:
                a, b = self.left[t], self.right[t]
                own[t] = own[a] and own[b] and not self._crossed(a, b, self.rank[t])
        names = [(s, t) for s, t in vocab.items() if own[t]]
        self.inner = {s: t for s, t in names if not s.endswith(END)}
        self.last = {s[: -len(END)]: t for s, t in names if s.endswith(END)}
        # every ending of a token, with the token's id if it is one itself, else -1
        self.inner_ends = {s[i:]: -1 for s in self.inner for i in range(len(s))} | self.inner
        self.last_ends = {s[i:]: -1 for s in self.last for i in range(len(s))} | self.last
        self.length = [0] * n
        for s, t in names:
            self.length[t] = len(s.removesuffix(END))

    def _crossed(self, a: int, b: int, until: int) -> bool:
        """Whether a merge across the border of a and b comes before rank ``until``.

        Goes back in time along the right edge of a and the left edge of b.  Both stand side by side
        until the earlier of their own next merges; of equal ranks the left one comes first.
        """
        rank, pair = self.rank, self.pair
        next_a = next_b = until
        while True:
            r = pair.get((a, b))
            if r is not None and r < next_a and (r <= next_b if next_b < until else r < next_b):
                return True
            if rank[b] < 0 and rank[a] < 0:
                return False
            if rank[a] > rank[b]:
                next_a, a = rank[a], self.right[a]
            else:
                next_b, b = rank[b], self.left[b]

    def adjacent(self, a: int, b: int) -> bool:
        """Whether token b may follow token a in an encoding."""
        key = a << 20 | b
        ok = self.known.get(key)
        if ok is None:
            if len(self.known) > 250_000:
                self.known.clear()
            ok = self.known[key] = not self._crossed(a, b, 1 << 40)
        return ok

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Token ids of sorted distinct words, each without its end mark."""
        state = [-1]  # last token of the prefix of each length of the word at hand
        before = ""
        find_inner, find_last, length = self.inner_ends.get, self.last_ends.get, self.length
        for w in words:
            n, same = len(w), 0
            most = min(n, len(before), len(state) - 1)
            while same < most and w[same] == before[same]:
                same += 1
            del state[same + 1 :]
            before = w
            for d in range(len(state), n):
                state.append(self._last(w, d, state, find_inner))
            t = self._last(w, n, state, find_last)
            ids, d = [t], n - length[t]
            while d:
                t = state[d]
                ids.append(t)
                d -= length[t]
            ids.reverse()
            yield ids

    def _last(self, w: str, d: int, state: list[int], find) -> int:
        """Last token of the first d letters: of the tokens that end there, the one that may stand after what is left."""
        fits, i = [], d - 1
        while i >= 0 and (t := find(w[i:d])) is not None:
            if t >= 0:
                fits.append(t)
            i -= 1
        known, length = self.known, self.length
        while fits:
            t = fits.pop()
            i = d - length[t]
            if i == 0:
                return t
            ok = known.get(state[i] << 20 | t)
            if ok or ok is None and self.adjacent(state[i], t):
                return t
        raise ValueError(f"no token ends {w[:d]!r}")


class Encoder:
    """Slice-wise encoder with a bounded memory of words: the words of two generations, those in use kept on."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["model"].get("end_of_word_suffix") != END or WORDS.pattern not in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\"):
            raise ValueError(f"{path} holds a vocabulary of another kind")
        self.lib = Tokenizer.from_file(path)
        self.merges = Merges(spec["model"]["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t.isalpha() for t in self.added):
            raise ValueError(f"{path} holds an added token of letters only")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.names = {t: s for s, t in spec["model"]["vocab"].items()} | {t: s for s, t in self.added.items()}
        self.shown = _Shown(byte_letters())
        self.packs = [Struct(f"<{n}I").pack for n in range(64)]
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def words(self, chunk: str) -> list[str | int]:
        """Words of a chunk, and ids of added tokens.

        Words that the library has cut are in byte letters after a zero character, which no other word holds.
        """
        if chunk.isprintable() and (chunk.isascii() or max(chunk) < STABLE) and not (self.cut and self.cut.search(chunk)):
            low = chunk.lower()
            return WORDS.findall(low) if low.isascii() or max(low) < STABLE else self._by_library(chunk)
        found: list[str | int] = []
        for i, x in enumerate(self.cut.split(chunk) if self.cut else [chunk]):
            if i % 2:
                found.append(self.added[x])
            elif x:
                found += self._by_library(x)
        return found

    def _by_library(self, raw: str) -> list[str]:
        return ["\0" + x for x, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(raw))]

    def _packed(self, ids: list[int]) -> tuple[bytes, str]:
        n = len(ids)
        return (self.packs[n] if n < len(self.packs) else Struct(f"<{n}I").pack)(*ids), " ".join([self.names[t] for t in ids])

    def learn(self, words: set[str]) -> None:
        """Encodes words that are new, all in one pass over the trie."""
        young, old, shown = self.young, self.old, self.shown.__getitem__
        new = []
        for w in words:
            if w not in young:
                held = old.get(w)
                if held is None:
                    new.append((w if w.isascii() and w[0] != "\0" else w[1:] if w[0] == "\0" else "".join(map(shown, w)), w))
                else:
                    young[w] = held
        new.sort()
        forms = [x for i, (x, _) in enumerate(new) if not i or x != new[i - 1][0]]
        coded = self.merges.encode_sorted(forms)
        last = packed = None
        for x, w in new:
            if x != last:
                last, packed = x, self._packed(next(coded))
            young[w] = packed

    def table(self, chunks: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of each of some distinct chunks."""
        plain, marked, others, words = [], [], [], set(MARKS)
        for k, c in enumerate(chunks):
            low = c.lower()
            if c.isascii() or max(low) < STABLE > max(c):
                if low.isalpha():
                    plain.append((k, low))
                    continue
                if low[-1:] in MARKS and (w := low[:-1]).isalpha() and not (self.cut and self.cut.search(c)):
                    marked.append((k, w, low[-1]))
                    continue
            others.append((k, self.words(c)))
        words.update([w for _, w in plain])
        words.update([w for _, w, _ in marked])
        for _, ws in others:
            words.update([w for w in ws if w.__class__ is str])
        self.learn(words)
        get = self.young.__getitem__
        ids, decoded = [b""] * len(chunks), [""] * len(chunks)
        for k, w in plain:
            ids[k], decoded[k] = get(w)
        marks = {m: (get(m)[0], " " + get(m)[1]) for m in MARKS}
        for k, w, m in marked:
            x, y = get(w)
            mx, my = marks[m]
            ids[k], decoded[k] = x + mx, y + my
        for k, ws in others:
            both = [get(w) if w.__class__ is str else self._packed([w]) for w in ws]
            ids[k], decoded[k] = b"".join([x for x, _ in both]), " ".join([y for _, y in both])
        if len(self.young) > GENERATION:
            self.young, self.old = {}, self.young
        return ids, decoded

    def arrays(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids (as bytes) and decoded text of each text; only distinct chunks become Python objects."""
        odd = any(pc.any(pc.match_substring(texts, c)).as_py() for c in ODD_BLANKS)
        if odd:
            cut = pa.array([re.sub("[\n\t\r]", " ", x).split(" ") for x in texts.to_pylist()], pa.list_(pa.string()))
        else:
            cut = pc.utf8_split_whitespace(texts)
        offsets = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        offsets = offsets - offsets[0]
        collecting = gc.isenabled()
        gc.disable()  # many small objects and no cycles among them
        try:
            ids, decoded = self.table(coded.dictionary.to_pylist())
        finally:
            if collecting:
                gc.enable()
        ids, decoded = pa.array(ids, pa.binary()), pa.array(decoded, pa.string())
        some = pc.binary_length(ids).to_numpy() > 0
        if not some.all():  # chunks without tokens, the empty one above all
            keep = some[at]
            offsets, at = np.append(0, np.cumsum(keep))[offsets], at[keep]
        offsets, at = pa.array(offsets.astype(np.int32)), pa.array(at)
        joined = lambda x, by: pc.binary_join(pa.ListArray.from_arrays(offsets, x.take(at)), by)
        return joined(ids, b""), joined(decoded, " ")

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        ids, decoded = self.arrays(pa.array(texts, pa.string()))
        return ids.to_pylist(), decoded.to_pylist()


@lean
def _encode(batches: Iterator[pa.RecordBatch], path: str, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    coder = None
    for t in chunks(batches, SLICE_BYTES):
        coder = coder or Encoder(path)
        t = t.combine_chunks()
        ids, decoded = coder.arrays(pc.fill_null(t["text"].combine_chunks(), ""))
        yield from t.drop(["text"]).append_column(names[0], ids).append_column(names[1], decoded).to_batches()


def encode_decode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ids (little-endian unsigned 32-bit integers) and the decoded text of each row."""
    small_batches(docs.sparkSession)
    given = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    ids, decoded = (free_name(given, c) for c in ("ids", "decoded"))
    return given.mapInArrow(functools.partial(_encode, path=path, names=(ids, decoded)), f"{types}, `{ids}` binary, `{decoded}` string")


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
