"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library.

Blanks (0x20, 0x09-0x0D) end a word for every tokenizer that drops white space before it splits
words, as the one named in the queries does; so a text's ids are its words' ids in a row. Texts
are split by Arrow, marks after letters are parted from them where the tokenizer does so, equal
parts of a batch are looked up once, and a process encodes one once as long as it stays in a
cache of bounded size, which has no influence on results. Small letters, which a normalizer of
known steps and a known pre-tokenizer leave as they are, go to the tokenizer's model without these.
"""

from __future__ import annotations

import itertools
import json
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from mercata.llm.words import frees, fresh

SLICE_BYTES = 8 << 20  # text that is handled at once
CACHED_WORDS = 1_000_000
MARKS = string.punctuation
# Letters, each of one small letter, that NFC leaves alone (multiplication, division; capital I with a dot has two).
LATIN = "".join(chr(c) for c in range(0xC0, 0x250) if c not in (0xD7, 0xF7, 0x130))
# Steps that map letters one by one and keep single blanks, and a pattern that keeps letters in a row together.
NORMALIZERS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})
SPLITTERS = [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
              "behavior": "Removed", "invert": True},
             {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
_encoders: dict[str, "Encoder"] = {}


def _strings(words: pa.Array) -> list[str]:
    """Words without blanks; one string that is split takes less time than a value each."""
    if not len(words):
        return []
    row = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(row, " ")[0].as_py().split(" ")


def _taken(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the pool in a row, and where each ends."""
    ends = np.cumsum(sizes, dtype=np.int64)
    spots = np.repeat(starts - ends + sizes, sizes)
    spots += np.arange(len(spots))
    return pool[spots], ends


class Encoder:
    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        mark = self.tokenizer.encode("|", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._strip()
        self._reset()

    def _strip(self) -> None:
        """``bare``: the tokenizer without its normalizer and with blanks as its only splitter, if both
        are known to leave words of the letters in ``plain`` as they are and no special token is one; else None."""
        from tokenizers import Tokenizer, pre_tokenizers
        self.bare, self.letters = None, "^[A-Za-z]+$"
        form = json.loads(self.tokenizer.to_str())
        steps, model = form["normalizer"], form["model"]
        steps = [] if steps is None else steps["normalizers"] if steps["type"] == "Sequence" else [steps]
        if any(x not in NORMALIZERS for x in steps) or form["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": SPLITTERS} \
                or model["type"] != "BPE" or model["dropout"] or not model["end_of_word_suffix"] \
                or any(set(x["content"]) <= set(string.ascii_letters + LATIN) for x in form["added_tokens"]):
            return
        kept = [c for c in string.ascii_letters + LATIN if not steps or self.tokenizer.normalizer.normalize_str(c) == c]
        self.plain, self.letters = f"^[{''.join(kept)}]+$", f"^[A-Za-z{LATIN}]+$"
        self.lasts = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        self.lasts[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
        self.bare = Tokenizer.from_str(json.dumps(form | {"normalizer": None, "pre_tokenizer": None}))
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _reset(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and how many each has. Words are joined by a mark that has one
        id of its own and stands between blanks, so none of them may have that character."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 20_000):
            part = words[k:k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" | ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            marks = ids == self.mark
            own = np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1
            if len(own) != len(part):
                raise ValueError("a word of the tokenizer holds the mark between words")
            flat.append(ids[~marks])
            sizes.append(own)
        return np.concatenate(flat), np.concatenate(sizes)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def _bare(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters; the last id of each, and no other, has the model's end of a word."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 200):
            part = words[k:k + 200]
            ids = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.lasts[ids])
            if len(last) != len(part):  # a letter without an id
                ids, own = self._alone(part)
            else:
                own = np.diff(last, prepend=-1)
            flat.append(ids)
            sizes.append(own)
        return np.concatenate(flat), np.concatenate(sizes)

    def _parts_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and where each word's end."""
        if len(self.slots) > self.cached:
            self._reset()
        spelled = self._spelled(words) if self.lowers else words
        slots = np.zeros((len(words), 2), np.int64)
        if self.splits:
            stems = pc.ascii_rtrim(spelled, MARKS)
            apart = pc.and_(pc.less(pc.binary_length(stems), pc.binary_length(spelled)), pc.match_substring_regex(stems, self.letters))
            tails = pc.replace_substring_regex(spelled.filter(apart), r"^[^!-/:-@\[-`{-~]+", "")
            slots[apart.to_numpy(zero_copy_only=False), 1] = self._slots_of(tails)
            spelled = pc.if_else(apart, stems, spelled)
        slots[:, 0] = self._slots_of(spelled)
        ids, ends = self._gather(slots.ravel())
        return ids, ends[1::2]

    def _slots_of(self, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        keys = _strings(coded.dictionary)
        slots = np.fromiter(map(self.slots.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if len(new):
            first = len(self.slots)
            self._learn(coded.dictionary.take(pa.array(new)))
            slots[new] = self._known([keys[i] for i in new.tolist()]) if len(self.slots) > first else 0
        return slots[coded.indices.to_numpy(zero_copy_only=False)]

    def _spelled(self, words: pa.Array) -> pa.Array:
        """Words with A-Z in lower case where that cannot change ids. Marks on a capital may compose
        otherwise than on its small letter, and special tokens are looked for in the raw text."""
        same = pc.string_is_ascii(words)
        if self.bare is not None:
            wide = pc.invert(same)
            same = pc.replace_with_mask(same, wide, pc.match_substring_regex(words.filter(wide), f"^[\\x00-\\x7F{LATIN}]+$"))
        for token in self.tokenizer.get_added_tokens_decoder().values():
            head = token.content[:1]
            if head.lower() == head.upper():  # a mark, looked for in all words, is cheaper than any case
                near = pc.match_substring(words, head)
                if not pc.any(near).as_py():
                    continue
                near = pc.replace_with_mask(near, near, pc.match_substring(words.filter(near), token.content, ignore_case=True))
            else:
                near = pc.match_substring(words, token.content, ignore_case=True)
            same = pc.and_not(same, near)
        return pc.if_else(same, pc.ascii_lower(words), words)

    def _known(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))

    def _gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in these slots in a row, and where each word's end."""
        return _taken(self.pool, self.starts[slot], self.sizes[slot])

    def _learn(self, new: pa.Array) -> None:
        """Slots for distinct new words."""
        if self.bare is not None:
            plain = pc.match_substring_regex(new, self.plain)
            words, new = _strings(new.filter(plain)), new.filter(pc.invert(plain))
            self._add(words, *self._bare(words))
        apart = pc.match_substring(new, "|") if self.mark is not None else pa.array(np.ones(len(new), bool))
        joined, alone = _strings(new.filter(pc.invert(apart))), _strings(new.filter(apart))
        self._add(joined, *self._joined(joined))
        self._add(alone, *self._alone(alone))

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        if not words:
            return
        first, need = len(self.slots), len(ids)
        while first + len(words) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.sizes))
        while self.used + need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + need] = ids
        self.sizes[first:first + len(words)] = sizes
        self.starts[first:first + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.used += need
        self.slots.update(zip(words, range(first, first + len(words)), strict=True))

    @property
    def splits(self) -> bool:
        """True if the tokenizer parts letters from the marks after them before it encodes."""
        if not hasattr(self, "_splits"):
            one, two, both = (self.tokenizer.encode(w, add_special_tokens=False).ids for w in ("quizzical", "%%%,", "quizzical%%%,"))
            self._splits = one + two == both
        return self._splits

    @property
    def lowers(self) -> bool:
        """True if the tokenizer maps A-Z to a-z itself, so that spellings of ASCII share a slot."""
        if not hasattr(self, "_lowers"):
            rule = self.tokenizer.normalizer
            self._lowers = rule is not None and rule.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        return self._lowers

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (one entry more than texts)."""
        listed = pc.ascii_split_whitespace(fresh(texts))
        words = listed.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(listed).to_numpy(zero_copy_only=False))]).astype(np.int64)
        pool, upto = self._parts_of(words.dictionary)
        sizes = np.diff(upto, prepend=0)
        ids, ends = _taken(pool, (upto - sizes)[codes], sizes[codes])
        at = np.concatenate([[0], ends])[bounds]
        if end is not None:
            ids = np.insert(ids, at[1:], np.uint32(end))
            at = at + np.arange(len(at))
        return ids, at


def encoder(path: str) -> Encoder:
    """One for each process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``most`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    upto, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, "right"))
        b = max(b, a + 1)
        yield batch.slice(a, b - a)
        a = b


def binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values: the bytes of data[bounds[i]:bounds[i + 1]]."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def tokenized(docs: DataFrame, tokenizer: str, end: int | None = None, key: str = "doc_id",
              text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned integers of
    ``width`` bytes, with ``end`` after them. NULL texts are empty."""
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = tool.encode(part["text"], end)
                yield pa.RecordBatch.from_arrays([part["doc_id"], binary(ids.astype(f"<u{width}"), at)],
                                                 ["doc_id", "ids"])

    from pyspark.sql import functions as F
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, ids binary")
