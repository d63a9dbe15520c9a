"""Token ids of whole texts, with every distinct word encoded once per task."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

PLAIN = "^[a-zß-öø-ÿ]+$"  # lower-case letters that are one piece for the splitter and the normalizer
KNOWN = 600_000
JOINED = 100
BATCH = 4_000


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """A tokenizer whose words end at white space, applied word by word.

    Texts are split at ASCII white space and before the full stops and commas that follow a
    letter, where this tokenizer splits as well. Words of plain letters are encoded many at a
    time, told apart by the word-end mark of their last id; all others singly. Texts that may
    hold a special token are encoded whole. Encoded words are kept up to ``KNOWN`` of them; past that, the store
    starts anew, which changes no result.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.by_word = bool(suffix) and spec.get("post_processor") is None
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.last = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
        for token, number in spec["model"]["vocab"].items():
            self.last[number] = bool(suffix) and token.endswith(suffix)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = [np.zeros(0, np.uint32)]
        self.lengths = [np.zeros(0, np.int64)]

    def learn(self, words: list[str]) -> None:
        plain = np.asarray(pc.match_substring_regex(pa.array(words, pa.large_string()), PLAIN))
        alone = [words[i] for i in np.flatnonzero(plain)]
        for k in range(0, len(alone), BATCH):
            some = alone[k : k + BATCH]
            lines = [" ".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self._encode(lines)])
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not mark word ends")
            self._add(some, ids, np.diff(ends, prepend=0))
        rest = [words[i] for i in np.flatnonzero(~plain)]
        for k in range(0, len(rest), BATCH):
            some = rest[k : k + BATCH]
            found = [e.ids for e in self._encode(some)]
            self._add(some, np.array([i for ids in found for i in ids], np.uint32), np.array(list(map(len, found))))

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.ids.append(ids)
        self.lengths.append(lengths.astype(np.int64))

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text. Null counts as empty."""
        texts = column.cast(pa.large_string()).fill_null("")
        whole = pc.match_substring(texts, self.specials[0], ignore_case=True) if self.specials else pa.array([False] * len(texts))
        for special in self.specials[1:]:
            whole = pc.or_(whole, pc.match_substring(texts, special, ignore_case=True))
        whole = np.asarray(whole.fill_null(False)) if self.by_word else np.ones(len(texts), bool)
        split = pc.if_else(pa.array(whole), "", texts)
        split = pc.ascii_lower(split)
        split = pc.replace_substring_regex(split, "([a-zß-öø-ÿ])([.,])", "\\1 \\2")
        words = pc.ascii_split_whitespace(split)
        flat = words.flatten()
        flat = flat.filter(pc.not_equal(flat, ""))
        counts = np.asarray(pc.list_value_length(words)) - self._blanks(words)
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.place) > KNOWN:
            self.forget()
        new = [w for w in names if w not in self.place]
        if new:
            self.learn(new)
            self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        place = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        word = place[np.asarray(coded.indices)] if len(names) else np.zeros(0, np.int64)
        length = self.lengths[0][word]
        begin = (np.cumsum(self.lengths[0]) - self.lengths[0])[word]
        before = np.concatenate([[0], np.cumsum(length)])
        source = np.arange(before[-1]) + np.repeat(begin - before[:-1], length)
        ids = self.ids[0][source]
        bounds = before[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        if whole.any():
            own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in np.flatnonzero(whole):
                own[i] = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
            ids = np.concatenate(own)
        return ids, bounds

    @staticmethod
    def _blanks(words: pa.Array) -> np.ndarray:
        """Empty pieces per text, which splitting leaves at its ends."""
        blank = np.concatenate([[0], np.cumsum(np.asarray(pc.equal(words.flatten(), "")))]).astype(np.int64)
        offsets = np.asarray(words.offsets) - words.offsets[0].as_py()
        return blank[offsets[1:]] - blank[offsets[:-1]]


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
