"""Token counts by the whole-token shortcut: what the vocabulary holds whole is counted, only the rest is merged.

Offline, on the driver, every vocabulary string is encoded by itself; those that give exactly their own id are proven
whole tokens (at most as many as the vocabulary has, so the set travels with the tasks).  In a task a text is cut before
white space that follows a visible character.  There the pre-tokenizer always ends a pre-token and nothing before it
depends on what follows, so a piece encodes alike alone and in its text: a proven piece counts one.  Any other piece is
split by the library's own pre-tokenizer; its proven pre-tokens count one each and the rest go through the merges.
Texts with an added token's string in them, or with the cut mark, are encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands at cuts; a text that has it is encoded whole.
_MARK = "\0"
#: A visible character and white space after it: letters, numbers, marks, punctuation and symbols are never white space.
_CUT = r"([\pL\pN\pM\pP\pS])([ \n\r\t])"
#: Bytes of text that are cut at once, and of pieces that a task remembers.
BLOCK_BYTES = 8 << 20
REMEMBERED_BYTES = 24 << 20
#: (tokens, of these counted by the shortcut) of a proven piece and of an empty text.
_ONE, _NONE = (1, 1), (0, 0)


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    if tokenizer.normalizer is not None or not isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) \
            or tokenizer.pre_tokenizer.add_prefix_space or not tokenizer.pre_tokenizer.use_regex:
        raise ValueError("the shortcut is proven for byte-level tokenizers that take texts as they are")
    return tokenizer


def proven_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings, in the byte-level alphabet, that encode alone as one token: themselves."""
    tokenizer = _load(path)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    names = [n for n in tokenizer.get_vocab() if n not in added]
    ids = tokenizer.get_vocab()
    return frozenset(n for n in names if [t.id for t in tokenizer.model.tokenize(n)] == [ids[n]])


def proven_texts(path: str) -> frozenset[str]:
    """The texts of proven tokens that are one pre-token by themselves: each encodes whole, alone, as its own id."""
    tokenizer = _load(path)
    texts = {n: tokenizer.decoder.decode([n]) for n in proven_tokens(path)}
    whole = [(n, t) for n, t in texts.items() if "�" not in t]
    ids = tokenizer.get_vocab()
    return frozenset(t for (n, t), e in zip(whole, tokenizer.encode_batch([t for _, t in whole], add_special_tokens=False))
                     if e.ids == [ids[n]])


def proven_characters(path: str) -> tuple[str, str, dict[int, str]]:
    """Letters, other visible characters (no apostrophe, which begins contractions), and both's byte-level spelling.

    Proven with the library's pre-tokenizer for characters up to U+024F: a letter joins an "a", an other a "!".
    """
    split = _load(path).pre_tokenizer.pre_tokenize_str
    chars = [chr(i) for i in range(0x21, 0x250) if chr(i) != "'"]
    letters = [c for c in chars if len(split("a" + c)) == len(split(c + "a")) == len(split(f" {c}a")) == 1]
    others = [c for c in chars if len(split("!" + c)) == len(split(c + "!")) == 1 and len(split("a" + c)) == 2]
    return "".join(letters), "".join(others), {ord(c): split(c)[0][0] for c in [" ", *letters, *others]}


class Counter:
    """Counts the tokens of texts; made anew for each task, so what it remembers ends with the task."""

    def __init__(self, path: str, tokens: frozenset[str], texts: frozenset[str], characters: tuple[str, str, dict[int, str]]):
        self.tokenizer, self.tokens, self.texts = _load(path), tokens, texts
        letters, others, self.spelling = characters
        self.word = re.compile(f"( ?[{re.escape(letters)}]+)([{re.escape(others)}]*)").fullmatch
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, tuple[int, int]] = {}
        self.room = REMEMBERED_BYTES

    def _piece(self, piece: str) -> tuple[int, int]:
        """(tokens, of these counted by the shortcut) of a piece that isn't proven as a whole."""
        if word := self.word(piece):  # letters, then others: the pre-tokenizer's parts, without asking it
            parts = [p.translate(self.spelling) for p in word.groups() if p]
        else:
            parts = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
        n = straight = 0
        for p in parts:
            if p in self.tokens:
                n, straight = n + 1, straight + 1
            else:
                n += len(self.tokenizer.model.tokenize(p))
        found = n, straight
        self.room -= 150 + 4 * len(piece)  # the entry's objects, and a string of at most four bytes a character
        if self.room < 0:
            self.known.clear()
            self.room = REMEMBERED_BYTES
        self.known[piece] = found
        return found

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, of these counted by the shortcut) of each text; none is null."""
        split = pc.split_pattern(pc.replace_substring_regex(texts, _CUT, rf"\1{_MARK}\2"), _MARK)
        pieces = pc.dictionary_encode(pc.list_flatten(split))
        whole, known = self.texts, self.known
        names = pieces.dictionary.to_pylist()
        found = [_ONE if p in whole else known.get(p) or self._piece(p) if p else _NONE for p in names]
        table = np.fromiter(chain.from_iterable(found), np.int64, 2 * len(found)).reshape(-1, 2)
        ends = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(table[pieces.indices.to_numpy()], axis=0)])
        at = split.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        counts = ends[at[1:]] - ends[at[:-1]]
        odd = pc.match_substring(texts, _MARK)
        for name in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, name))
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            ids = self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids
            counts[i] = len(ids), 0
        return counts[:, 0], counts[:, 1]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = size = 0
    while begin < len(texts):
        stop = max(begin + 1, int(np.searchsorted(ends, size + most, side="right")))
        yield texts.slice(begin, stop - begin)
        begin, size = stop, int(ends[stop - 1])


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_shortcut (tokens counted without merging), over_limit (n_tokens > ``limit``).

    One row for each row of ``docs``, repeated ones too, its other columns left out.  Null and empty texts have no bytes
    and no tokens; a null identifier stays null; an empty table gives an empty table.  No shuffle.
    """
    proven = proven_tokens(tokenizer_path), proven_texts(tokenizer_path), proven_characters(tokenizer_path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    def run(batches):
        counter = Counter(tokenizer_path, *proven)
        for b in batches:
            found = [counter.count(t) for t in blocks(b["text"])]
            n, straight = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_bytes"], pa.array(n), pa.array(straight)],
                                             ["doc_id", "n_bytes", "n_tokens", "n_shortcut"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, n_shortcut long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
