"""Token counts and ids by public tokenizers: memorised units for ordinary texts, overlapping chunks for huge ones."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import held, mapped, slices

#: A text of more characters is encoded in overlapping chunks.
HUGE = 1 << 16
CHUNK = 1 << 14
OVERLAP = 256
#: Bytes of memory that one Python worker's memo of units takes; beyond that it forgets all and starts again.
REMEMBERED = 80 << 20
#: Separable from a word of letters only: each of these patterns' tokenizers starts a new piece here.
_MARKS = ",.;:!?#*%$&"
#: White space beyond ASCII, over which units can't be told apart bytewise.
_WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_PIECES = re.compile(rb" ?[^\s]+|\s+(?!\S)|\s+")
_STABLE = " \t\n\r"

#: Under what name workers hold tokenizers and memos between tasks.
KEEPS = "tokens"


def load(path: str):
    """The tokenizer of a .json file, once for each Python process, without padding, truncation or threads of its own."""
    loaded = held(KEEPS)
    if path not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        loaded[path] = t
    return loaded[path]


def _ids(tok, text: str) -> list[int]:
    return tok.encode(text, add_special_tokens=False).ids


def splice(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of a huge text, as tok gives them for the whole of it, from chunks that overlap.

    Each chunk is encoded with offsets. Two neighbours are spliced where both have a boundary between tokens at the same
    place, ASCII white space stands right before it, no special token's string lies across it, and the tokens from there
    to the end of the overlap agree but for the last, which the chunk's end may have cut. For word-split tokenizers such
    a place is stable: no piece crosses white space from the left. If there is none, the overlap is doubled and the
    right chunk encoded anew; once it spans the left chunk, both become one chunk.
    """
    specials = [str(t) for t in tok.get_added_tokens_decoder().values()]
    specials = [t.content for t in tok.get_added_tokens_decoder().values()] or specials
    longest = max(map(len, specials), default=0)

    def crossed(x: int) -> bool:
        return any((k := text.find(s, max(0, x - len(s) + 1), x + len(s) - 1)) != -1 and k < x < k + len(s) for s in specials)

    def encode(a: int, b: int) -> list[tuple[int, int, int]]:
        e = tok.encode(text[a:b], add_special_tokens=False)
        return [(i, s + a, t + a) for i, (s, t) in zip(e.ids, e.offsets)]

    out: list[int] = []
    begin, end = 0, min(chunk, len(text))
    have = encode(0, end)
    while end < len(text):
        wide = overlap
        while True:
            a, b = max(begin, end - wide), min(len(text), end + chunk)
            if a == begin:  # the overlap has become the whole chunk
                end = b
                have = encode(begin, end)
                break
            right = encode(a, b)
            starts = {s: k for k, (_, s, _) in enumerate(right)}
            cut = None
            for k in range(len(have) - 1, 0, -1):
                x = have[k][1]
                if x <= a + longest:
                    break
                if x in starts and x < end - longest and text[x - 1] in _STABLE and have[k - 1][2] <= x and not crossed(x):
                    j = starts[x]
                    if j and right[j - 1][2] > x:
                        continue
                    n = min(len(have) - k, len(right) - j) - 1
                    if n > 0 and have[k : k + n] == right[j : j + n]:
                        cut = (k, j, x)
                        break
            if cut:
                out += [i for i, _, _ in have[: cut[0]]]
                have, begin, end = right[cut[1] :], cut[2], b
                break
            wide *= 2
    return out + [i for i, _, _ in have]


class Memo(dict):
    """What units of text came to, within REMEMBERED bytes; made() works out what isn't there."""

    def __init__(self, tok):
        super().__init__()
        self.tok, self.held = tok, 0

    def __missing__(self, unit: bytes):
        text = unit.decode("utf-8")
        stem = text.rstrip(_MARKS)
        if stem and len(stem) < len(text) and _ends_in_letter(stem):
            cut = len(stem.encode())
            got = self[unit[:cut]] + self[unit[cut:]]
        else:
            got = self.made(text)
        self.held += 170 + 5 * len(unit)  # both objects, an id a byte at most, and their share of the dictionary
        if self.held > REMEMBERED:
            self.clear()
            self.held = 0
        self[unit] = got
        return got


class Counter(Memo):
    """Tokens of a unit without white space, lower case in A-Z; only for tokenizers that split at white space and drop it."""

    def made(self, text: str) -> int:
        return len(_ids(self.tok, text))


class Units(Memo):
    """Ids, as little-endian 32-bit, of a unit of byte-level BPE: an optional space and what stands up to white space."""

    def __init__(self, tok, ranks=None):
        super().__init__(tok)
        self.ranks = ranks

    def made(self, text: str) -> bytes:
        return array("I", self.ranks.encode_ordinary(text) if self.ranks else _ids(self.tok, text)).tobytes()


def _ends_in_letter(stem: str) -> bool:
    """Whether the last character of stem, as it is and as tokenizers normalise it, is a letter and was one in old versions of
    Unicode too. The marks after it are then a piece of their own. (A capital I with dot becomes i and a combining dot,
    which isn't a letter and goes with the marks.)"""
    if stem.isascii():
        return stem[-1].isalpha()
    last = unicodedata.normalize("NFC", stem).lower()[-1]
    return all(unicodedata.ucd_3_2_0.category(c)[0] == "L" for c in (stem[-1], last))


def count(text: str, counter: Counter) -> int:
    if len(text) > HUGE:
        return len(splice(counter.tok, text))
    if "<|" in text or _WIDE.search(text):
        return len(_ids(counter.tok, text))
    return sum(map(counter.__getitem__, text.encode().lower().split()))


def encoded(text: str, units: Units) -> bytes:
    """The ids of a text by a byte-level BPE of the usual pattern, as little-endian 32-bit."""
    if "<|" in text or _WIDE.search(text):
        return array("I", splice(units.tok, text) if len(text) > HUGE else _ids(units.tok, text)).tobytes()
    return b"".join(map(units.__getitem__, _PIECES.findall(text.encode())))


def counter(path: str) -> Counter:
    loaded = held(KEEPS)
    if (key := f"count {path}") not in loaded:
        loaded[key] = Counter(load(path))
    return loaded[key]


def units(path: str, ranks_path: str | None = None) -> Units:
    loaded = held(KEEPS)
    if (key := f"units {path}") not in loaded:
        ranks = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            ranks = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        loaded[key] = Units(load(path), ranks)
    return loaded[key]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    path: a tokenizer file that every executor has. Null text is empty and has 0 of both; null and repeated ids pass
    through row by row; no rows in, no rows out; other columns are ignored. No shuffle.
    """

    kind = docs.schema[id_col].dataType.simpleString()

    def run(it):
        c = counter(path)
        for batch in slices(it):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            n = [count(t, c) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").transform(mapped, run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", KEEPS)
    return out.withColumnRenamed("id", id_col)
