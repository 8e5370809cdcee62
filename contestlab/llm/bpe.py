"""BPE encoding and decoding of whole texts with a public word-level vocabulary file (path is a parameter).

Method. Each word is short, so its state is one contiguous array of parts: the boundary where a part begins and the rank
of the pair it forms with the next part. The minimum rank is found by scanning the array, the boundary between that pair
is deleted, and only the ranks of the two neighbours are looked up again, until no adjacent pair has a rank. Words that
come back are read from a cache of bounded size.

What surrounds the words is read from the file: added tokens are cut out of the raw text, the rest goes through NFC,
white space folding and lower case by character, and is split by the file's pattern; bytes are written in the usual
256-letter byte alphabet and the last one carries the end-of-word mark. A file without a decoder joins the tokens'
strings by one space.

Scale. One pass without a shuffle; each task holds one Arrow batch and a cache of at most ``CACHE_WORDS`` words. The
vocabulary (about 2 MB, fixed size) is read once on the driver and sent as a broadcast variable.

Defined cases: null text counts as empty (no tokens); rows repeated, null ids and other columns change nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import small_batches

CACHE_WORDS = 200_000
_NO_RANK = 1 << 60


#: Code points that newer Unicode tables call letters or numbers and the tables of the vocabulary's
#: splitter (Unicode 16) do not.
LATE = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
#: Capitals (with their small letters) that are newer than Python's tables.
LATE_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LATE_CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, other = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(other))
            other += 1
    return out


def lower(text: str) -> str:
    """Lower case character by character (no rule for the end of a word)."""
    if text.isascii():
        return text.lower()
    text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
    return text.translate(LATE_CAPITALS) if _CAPITAL.search(text) else text


_CAPITAL = regex.compile("[" + "".join(map(chr, LATE_CAPITALS)) + "]")
_LATE = regex.compile(f"[{LATE}]")


class Bpe:
    """Encoder and decoder for one vocabulary file, given as the JSON text's parsed object."""

    def __init__(self, spec: dict, cache_words: int = CACHE_WORDS) -> None:
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or spec["post_processor"]:
            raise ValueError("the vocabulary file is not of the kind that this encoder reads")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # pair of ids -> rank, and rank -> id of what the pair becomes
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: i for i, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: s for s, i in {**self.vocab, **self.added}.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern)
        for p in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(p, f"[{p}--[{LATE}]]")
        self.late_pattern = regex.compile("(?V1)" + pattern)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = _Cache(self._word, cache_words)
        self.cache = _Cache(self._piece, cache_words)

    def merge(self, word: str) -> list[int]:
        """Token ids of one word by the contiguous rank array: ``parts[i]`` is the part that begins at boundary ``i`` and
        ``ranks[i]`` the rank of the pair at the boundary after it."""
        data = word.encode()
        if not data:
            return []
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << 20 | b, _NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == _NO_RANK:
                break
            i = ranks.index(best)
            parts[i] = merged[best]
            del parts[i + 1], ranks[i]  # the boundary between the two
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], _NO_RANK)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 20 | parts[i + 1], _NO_RANK)
        return parts

    def pieces(self, text: str) -> list[str]:
        """What the file's pattern makes of a text without added tokens."""
        text = lower(unicodedata.normalize("NFC", text))
        return (self.pattern if text.isascii() or not _LATE.search(text) else self.late_pattern).findall(text)

    def _found(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def _piece(self, piece: str) -> tuple[int, str, str]:
        return self._found(self.merge(piece))

    def _word(self, word: str) -> tuple[int, str, str]:
        low = lower(unicodedata.normalize("NFC", word))
        if low.isalpha():  # letters only are one piece of the pattern
            return self.cache[low]
        if low[-1] in ".,;:!?" and low[:-1].isalpha():
            a, b = self.cache[low[:-1]], self.cache[low[-1]]
            return a[0] + b[0], f"{a[1]} {b[1]}", f"{a[2]} {b[2]}"
        found = [self.cache[p] for p in self.pieces(word)]
        return sum(f[0] for f in found), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    def tokens_of(self, text: str) -> list[tuple[int, str, str]]:
        """Number of tokens, ids and decoded text of each part of a text.

        No piece holds white space and neither NFC nor lower case looks across it, so words between white space are
        looked up as they stand."""
        out: list[tuple[int, str, str]] = []
        cut = self.cut is not None and any(t in text for t in self.added)
        for i, part in enumerate(self.cut.split(text) if cut else [text]):
            if i % 2:
                out.append(self._found([self.added[part]]))
                continue
            words = part.split() if not _PYTHON_SPACE.search(part) else [w for w in _SPACE.split(part) if w]
            get = self.words
            out += [get[w] for w in words]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for f in self.tokens_of(text) for i in f[1].split()]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and the SHA-256 of the decimal ids and of the decoded text."""
        found = self.tokens_of(text)
        ids, said = " ".join([f[1] for f in found]), " ".join([f[2] for f in found])
        return sum([f[0] for f in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


_SPACE = regex.compile(r"\p{White_Space}+")
#: What ``str.split`` takes for white space and the pattern does not.
_PYTHON_SPACE = re.compile("[\x1c-\x1f]")


class _Cache(dict):
    """Made entries by key; emptied when full, so memory stays bounded."""

    def __init__(self, make, size: int) -> None:
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key: str):
        found = self.make(key)
        if len(key) <= 64:  # longer ones seldom come back
            if len(self) >= self.size:
                self.clear()
            self[key] = found
        return found


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids, decoded`` with ``texts``)."""
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        bpe = Bpe(spec.value)
        for b in batches:
            found = [bpe.digests(t or "") for t in b.column("text").to_pylist()]
            n, ids_sha, said_sha = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(said_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if texts:
                ids = [bpe.encode(t or "") for t in b.column("text").to_pylist()]
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<int>, decoded string" * texts)
