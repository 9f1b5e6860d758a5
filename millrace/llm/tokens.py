"""Token ids of whole texts by a tokenizer file, as flat numpy arrays."""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.frames import whole, words_of

END = 2
SLICE_BYTES = 4 << 20  # of text encoded together
KEPT = 400_000  # words whose ids a worker remembers
_MARK = "\x01"
_STRETCH = 1 << 17
# precomposed Latin letters: stable under NFC, one letter in lower case
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_PROBE = ["the", "Über", "x", "naïve", "ÀÉÎÕÜ", "ßÿ", "antidisestablishmentarianism", "zzqxj"]
# a Latin letter and a full stop or comma never lie in one pre-token of a by-word tokenizer;
# U+0130 is left out, since its lower case ends in a mark that may join the stop
_STOP = r"([A-Za-zÀ-ÖØ-öø-\x{12F}\x{131}-\x{24F}])([.,])"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=1)
def encoder(path: str, by_word: bool = True) -> Encoder:
    """The worker's encoder: made once, used by all its tasks."""
    return Encoder(path, by_word)


class Encoder:
    """Ids of texts, with the end id after each text.

    `by_word` is for tokenizers that drop white space and never join signs across it: then a
    text's ids are its words' ids in a row, and each different word of a batch is encoded
    once. Words go to the library many at a time. Most are Latin letters only, which the
    normaliser just turns to lower case and the pre-tokenizer leaves whole; these go through
    the file's model without the two, and an id with the end-of-word mark ends each. The
    others are sent with a sign between them that no other word shares; words that hold the
    sign are encoded alone.
    """

    def __init__(self, path: str, by_word: bool = True, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.by_word, self.end = Tokenizer.from_file(path), by_word, end
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.plain, self.slot = None, {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int64)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if by_word and suffix:
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.closing = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.closing[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
            ids, ends = self._letters([w.lower() for w in _PROBE])
            if [x.tolist() for x in np.split(ids, ends[:-1])] != self._lists(_PROBE):
                self.plain = None

    def _lists(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends by word) of words of small Latin letters."""
        step = 4096
        sent = [" ".join(words[i:i + step]) for i in range(0, len(words), step)]
        ids = [np.array(e.ids, dtype=np.int32) for e in self.plain.encode_batch_fast(sent, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return ids, np.flatnonzero(self.closing[ids]) + 1

    def _known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends by slot, slot by word): as `_letters`, with the first KEPT different words kept between calls."""
        slots = [*map(self.slot.get, words)]
        new = [w for w, k in zip(words, slots) if k is None]
        if new:
            ids, ends = self._letters(new)
            kept = len(self.ends)
            all_ids, all_ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends + len(self.ids)])
            places = iter(range(kept, kept + len(new)))
            slots = [next(places) if k is None else k for k in slots]
            room = max(0, min(KEPT - kept, len(new)))
            if room:
                self.slot.update(zip(new[:room], range(kept, kept + room)))
                self.ends = all_ends[:kept + room]
                self.ids = all_ids[:self.ends[-1]]
        else:
            all_ids, all_ends = self.ids, self.ends
        return all_ids, all_ends, np.array(slots, dtype=np.int64)

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends by word) of any words."""
        alone = [i for i, w in enumerate(words) if _MARK in w] if self.mark is not None else list(range(len(words)))
        own = dict(zip(alone, self._lists([words[i] for i in alone])))
        sent = [w for i, w in enumerate(words) if i not in own]
        step = 4096
        chunks = [f" {_MARK} ".join(sent[i:i + step]) + f" {_MARK}" for i in range(0, len(sent), step)]
        flat = [np.array(ids, dtype=np.int32) for ids in self._lists(chunks)]
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        marks = np.flatnonzero(ids == self.mark) if sent else np.zeros(0, np.int64)
        if len(marks) != len(sent):
            raise ValueError("the tokenizer joins signs across white space: use by_word=False")
        ends = marks - np.arange(len(marks))
        ids = ids[ids != self.mark] if sent else ids
        if own:
            parts = iter(np.split(ids, ends[:-1]) if sent else [])
            lists = [np.array(own[i], dtype=np.int32) if i in own else next(parts) for i in range(len(words))]
            ids, ends = np.concatenate(lists), np.cumsum([len(x) for x in lists])
        return ids, ends

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start by word, number by word)."""
        plain = pc.match_substring_regex(words, _LETTERS) if self.plain else pa.array(np.zeros(len(words), bool))
        lower = pc.utf8_lower(words.filter(plain)).dictionary_encode()
        ids, ends, slots = self._known(lower.dictionary.to_pylist())
        more, more_ends = self._marked(words.filter(pc.invert(plain)).to_pylist())
        starts, counts = np.zeros((2, len(words)), dtype=np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        own = lower.indices.to_numpy(zero_copy_only=False)
        sizes, more_sizes = np.diff(ends, prepend=0), np.diff(more_ends, prepend=0)
        counts[is_plain], counts[~is_plain] = sizes[slots][own], more_sizes
        starts[is_plain], starts[~is_plain] = (ends - sizes)[slots][own], more_ends - more_sizes + len(ids)
        return np.concatenate([ids, more]), starts, counts

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text); a null text is empty, so it is the end id alone."""
        if not self.by_word:
            lists = self._lists(whole(column, pa.large_string()).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lists], dtype=np.int64)])
            return np.array([i for x in lists for i in (*x, self.end)], dtype=np.int32), offsets
        texts = pc.replace_substring_regex(whole(column, pa.large_string()), _STOP, r"\1 \2")
        codes, by_text, words = words_of(texts)
        word_ids, starts, sizes = self.words(words)
        starts, sizes = starts.astype(np.int32), sizes.astype(np.int32)
        totals = np.concatenate([[0], np.cumsum(sizes[codes], dtype=np.int64)])[by_text] + np.arange(len(by_text))
        out = np.empty(totals[-1], dtype=np.int32)
        # a stretch of texts at a time, so that the arrays between stay small and are used again
        cuts = [0, *(np.flatnonzero(np.diff(by_text // _STRETCH)) + 1), len(by_text) - 1]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                own = codes[by_text[a]:by_text[b]]
                counts = sizes[own]
                ends = np.cumsum(counts, dtype=np.int32)
                place = np.repeat(starts[own] - ends + counts, counts)
                place += np.arange(len(place), dtype=np.int32)
                stops = totals[a + 1:b + 1] - totals[a] - np.arange(1, b - a + 1)
                out[totals[a]:totals[b]] = np.insert(word_ids[place], stops, self.end)
        return out, totals
