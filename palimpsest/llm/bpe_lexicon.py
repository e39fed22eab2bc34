"""Operator 6, BPE encoding and decoding with a minimal acyclic transducer.

1. Spark counts the words of the whole corpus (native, map-side combined) and
   takes the most frequent ones, ``LEXICON`` at most.
2. These words and their token ids are compiled into a minimal acyclic
   automaton: equal suffixes share states, and the numbers on the arcs of a
   word add up to its place in the id table.  The automaton is a few flat
   arrays in one file of the shared folder; executors get it through
   ``SparkContext.addFile`` (a lost executor's successor fetches it again)
   and memory-map it.
3. Every task splits whole texts into words as the vocabulary file says, walks
   the words that its worker doesn't hold yet through the automaton all at
   once, and merges those that it doesn't know exactly, by the ranks of the
   merge list.

The lexicon only saves work: any word missing from it is merged to the same
ids.  The vocabulary file's path is a parameter; the driver reads it and sends
its text along (a file of fixed size).  Texts of plain Latin characters are
normalised and split here; a text with any other character goes through the
library's own normaliser and splitter, so the rules for rare scripts are the
library's.  A file whose normaliser, splitter or model isn't of the form written
here (``NORMALIZER``, ``PRE_TOKENIZER``) is run by the library as a whole.

Defined cases: null text counts as empty, and an empty text has no tokens;
special tokens' strings in a text are those tokens; a word of any length is
merged in n log n; null or repeated ids keep one result per input row; an
empty table gives an empty lexicon and result; other columns are left out
(the query) or kept.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_text, most_frequent, query, shared_path, stage, table, text_or_empty

LEXICON = 131_072
VOCABULARY = "word_bpe_49k.json"
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: the same splitting for lower-case ASCII texts, by the quicker standard library
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: fixed values: the normaliser and splitter of a vocabulary file that ``Bpe`` follows on its own
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: words whose ids and texts a worker keeps
HELD = 250_000
#: characters whose composition and lower case are the same in every Unicode version
PLAIN = regex.compile("[\\x00-\\u024F\\u2010-\\u205E\\u20A0-\\u20BF]*")


class Bpe:
    """The vocabulary file's model: words in, ids out."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(spec)
        model = spec["model"]
        self.follows = (
            spec.get("normalizer") == NORMALIZER and spec.get("pre_tokenizer") == PRE_TOKENIZER and model["type"] == "BPE"
            and spec.get("decoder") is None and spec.get("post_processor") is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
            and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"]))
        if not self.follows:
            return
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        found = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None
        self.piece = regex.compile(PIECE)
        # the byte alphabet: printable bytes stand for themselves, the rest for characters from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (b for b in range(256) if b not in own)
        self.chars = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def merge(self, word: str) -> list[int]:
        """Ids of a word: always the leftmost pair of the lowest rank, by a
        heap over a linked list of symbols."""
        sym = [self.chars[b] for b in word.encode("utf-8", "surrogatepass")]
        sym[-1] += self.end
        n = len(sym)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank = self.ranks.get
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, None
            after[i] = j = after[j]
            if j >= 0:
                before[j] = i
                if (r := rank((sym[i], sym[j]))) is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[j]))
            if (k := before[i]) >= 0 and (r := rank((sym[k], sym[i]))) is not None:
                heapq.heappush(heap, (r, k, sym[k], sym[i]))
        return [self.ids[s] for s in sym if s is not None and s in self.ids]

    def pieces(self, text: str) -> list[str]:
        """Words of a text; a special token's string is one 'word'."""
        if self.special_pattern is None or "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.special_pattern.split(text):
            out.extend([part] if part in self.special else self._plain(part))
        return out

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_PIECE.findall(text.lower())
        if PLAIN.fullmatch(text):
            return self.piece.findall(unicodedata.normalize("NFC", text).lower())
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def word_ids(self, word: str) -> list[int]:
        return [self.special[word]] if word in self.special else self.merge(word)


@functools.lru_cache(maxsize=2)
def _bpe(spec: str) -> Bpe:
    return Bpe(spec)


class _State:
    __slots__ = ("arcs", "final", "name")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.name = -1


def compile_lexicon(words: list[tuple[bytes, list[int]]]) -> bytes:
    """Minimal acyclic automaton of sorted distinct words, as flat arrays.

    Words are added in order; once a branch can't grow any more its states
    are replaced by equal ones seen before (same arcs, same finality)."""
    root, known, path, last = _State(), {}, [], b""

    def settle(down_to: int):
        while len(path) > down_to:
            parent, byte, child = path.pop()
            key = (child.final, tuple((b, s.name) for b, s in child.arcs.items()))
            if key in known:
                parent.arcs[byte] = known[key]
            else:
                child.name = len(known)
                known[key] = child

    for word, _ in words:
        if word <= last and last:
            raise ValueError("words must be sorted and distinct")
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        settle(same)
        at = path[-1][2] if path else root
        for byte in word[same:]:
            at.arcs[byte] = nxt = _State()
            path.append((at, byte, nxt))
            at = nxt
        at.final, last = True, word
    settle(0)
    root.name = len(known)
    states = [*known.values(), root]  # children come before their parents
    below = np.zeros(len(states), np.int64)  # words that can be finished from a state
    keys, targets, outs = [], [], []
    for s in states:
        n = int(s.final)
        for byte, t in sorted(s.arcs.items()):
            keys.append(s.name * 256 + byte)
            targets.append(t.name)
            outs.append(n)  # words that end here or leave by an earlier arc
            n += below[t.name]
        below[s.name] = n
    lengths = [len(i) for _, i in words]
    parts = [np.asarray(keys, "<i8"), np.asarray(targets, "<i4"), np.asarray(outs, "<i4"),
             np.asarray([s.final for s in states], "<i4"), np.concatenate(([0], np.cumsum(lengths))).astype("<i4"),
             np.asarray([x for _, i in words for x in i], "<i4")]
    return np.asarray([root.name, *map(len, parts)], "<i8").tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        self.path = path
        raw = np.memmap(path, np.uint8, "r")
        head = raw[:56].view("<i8")
        self.root, at, parts = int(head[0]), 56, []
        for n, kind in zip(head[1:], ("<i8", "<i4", "<i4", "<i4", "<i4", "<i4"), strict=True):
            size = int(n) * np.dtype(kind).itemsize
            parts.append(raw[at:at + size].view(kind))
            at += size
        self.keys, self.targets, self.outs, self.final, self.starts, self.values = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """The index of each word, -1 for unknown ones; all walk together."""
        n = len(words)
        found = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return found
        length = np.fromiter(map(len, words), np.int64, n)
        start = np.concatenate(([0], np.cumsum(length)[:-1]))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        who, state, index, step = np.arange(n), np.full(n, self.root, np.int64), np.zeros(n, np.int64), 0
        while len(who):
            done = length[who] == step
            if done.any():
                ends = done & (self.final[state] == 1)
                found[who[ends]] = index[ends]
                who, state, index = who[~done], state[~done], index[~done]
                if not len(who):
                    break
            key = state * 256 + flat[start[who] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[at] == key
            at, who, index = at[on], who[on], index[on]
            index = index + self.outs[at]
            state = self.targets[at].astype(np.int64)
            step += 1
        return found

    def ids(self, index: int) -> list[int]:
        return self.values[self.starts[index]:self.starts[index + 1]].tolist()


@functools.lru_cache(maxsize=2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def frequent_words(docs: DataFrame, size: int = LEXICON, text_col: str = "text") -> DataFrame:
    """The most frequent words of all texts (word, n), ``size`` at most."""
    pattern = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(pattern), F.lit(0))).alias("word"))
    counts = stage(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    return most_frequent(counts, "word", "n", size)


def build_lexicon(docs: DataFrame, spec: str, size: int = LEXICON, text_col: str = "text") -> str:
    """Count, compile, publish; returns the name under which tasks find it."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(spec)

    def run(batches):
        import pyarrow as pa

        bpe = _bpe(sent.value)
        for rb in batches:
            # a counted word that the tokenizer would split or change is never asked for
            words = [w for w in rb.column(0).to_pylist() if bpe.follows and w not in bpe.special and bpe._plain(w) == [w]]
            yield pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words], pa.binary()),
                                              pa.array([bpe.merge(w) for w in words], pa.list_(pa.int32()))], names=["word", "ids"])

    def compiled(batches):
        import pyarrow as pa

        pairs = [x for rb in batches for x in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([compile_lexicon(sorted(pairs))], pa.binary())], names=["raw"])

    coded = frequent_words(docs, size, text_col).select("word").repartition(12).mapInArrow(run, "word binary, ids array<int>")
    # ``size`` words at most meet in one task, away from the driver's memory
    raw = bytes(coded.coalesce(1).mapInArrow(compiled, "raw binary").first()["raw"])
    path = shared_path(spark, f"lexicon-{hashlib.sha1(raw).hexdigest()[:16]}") + ".fst"
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to, True)
    out.write(raw)
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


class Coder:
    """Words of a worker's texts to ids, through the lexicon first."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon):
        self.bpe, self.lexicon = bpe, lexicon
        self.held: dict[str, tuple] = {}

    def entries(self, words: set[str], entry) -> dict:
        """``entry(ids)`` of every word, kept from one lot of texts to the
        next; only words that aren't held are looked up or merged."""
        if len(self.held) > HELD:
            self.held.clear()
        new = [w for w in words if w not in self.held]
        found = self.lexicon.find([w.encode("utf-8", "surrogatepass") for w in new])
        for w, i in zip(new, found.tolist(), strict=True):
            special = self.bpe.special.get(w)
            self.held[w] = entry([special] if special is not None else self.lexicon.ids(i) if i >= 0 else self.bpe.merge(w))
        return self.held


@functools.lru_cache(maxsize=4)
def _coder(spec: str, lexicon: str, use: str) -> Coder:
    """One for each use in a worker process, so that words stay from task to task."""
    return Coder(_bpe(spec), _lexicon(lexicon))


def encode(docs: DataFrame, spec: str, lexicon: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus ``ids`` (array of int) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def run(texts):
        bpe = _bpe(sent.value)
        if not bpe.follows:
            return {"ids": [bpe.library.encode(t, add_special_tokens=False).ids for t in texts]}
        parts = [bpe.pieces(t) for t in texts]
        held = _coder(sent.value, lexicon, "ids").entries(set().union(*parts), tuple)
        return {"ids": [[i for w in p for i in held[w]] for p in parts]}

    return map_text(docs, keep, run, "ids array<int>", text_col, budget=2_000_000)


def decode_ids(bpe: Bpe, ids: list[int]) -> str:
    """No decoder in the file: token strings joined by a space."""
    names = bpe.names
    return " ".join([names[i] for i in ids if i in names])


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def round_trip(docs: DataFrame, spec: str, lexicon: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus n_tokens and the digests of ids and decoded text.  Ids
    are turned to text word by word, which is the same as id by id; a worker
    keeps each word's ids and decoded text as written."""
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def by_library(library, texts):
        ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
        return {"n_tokens": list(map(len, ids)), "ids_sha256": [_sha256(" ".join(map(str, i))) for i in ids],
                "decoded_sha256": [_sha256(library.decode(i, skip_special_tokens=False)) for i in ids]}

    def run(texts):
        bpe = _bpe(sent.value)
        if not bpe.follows:
            return by_library(bpe.library, texts)
        parts = [bpe.pieces(t) for t in texts]
        held = _coder(sent.value, lexicon, "texts").entries(
            set().union(*parts), lambda ids: (" ".join(map(str, ids)), decode_ids(bpe, ids), len(ids)))
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for p in parts:
            written, read, count = zip(*[held[w] for w in p], strict=True) if p else ((), (), ())
            out["n_tokens"].append(sum(count))
            out["ids_sha256"].append(_sha256(" ".join(written)))
            out["decoded_sha256"].append(_sha256(" ".join(read)))
        return out

    return map_text(docs, keep, run, "n_tokens long, ids_sha256 string, decoded_sha256 string", text_col, budget=2_000_000)


def vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


@query("op6_bpe_lexicon")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spec = table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()
    return round_trip(docs, spec, build_lexicon(docs, spec), ["doc_id"])


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: doc_id, lang, source and the ids of every document."""
    spec = vocabulary()
    return encode(docs, spec, build_lexicon(docs, spec), ["doc_id", "lang", "source"])
