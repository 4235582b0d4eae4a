"""Token ids of texts through the ids of their distinct words.

A tokenizer that never joins what a separator keeps apart gives a text the ids of its
words one after the other. So only words that a task has not met are
encoded, thousands in one text, and every other word is a look-up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

#: Words that a Python worker remembers; those not seen for long go. It only bounds memory: forgotten words are encoded again.
CACHE_WORDS = 800_000
_JOINED = 2_000


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its own character where that is visible, the others as U+0100 and on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class WordIds:
    """Look-up of the ids of words, as little-endian unsigned 32-bit ids in bytes.

    `encode_batch` gives the ids of each text. A text of many words is `lead`, then the
    words with `joiner` between them; its ids are cut where `mark` stands, a run of ids that only
    the joiner has. A word that holds `plain_only` is encoded by itself. `check` sees every
    joined text with its ids. `fast` gives the ids of words in another way, None for those that it cannot.
    `cache_bytes` bounds what is remembered by its size (the bytes of words and ids, and 100 for each), not by the number of words.
    """

    def __init__(
        self, encode_batch: Callable[[list[str]], list[list[int]]], joiner: str, plain_only: str, lead: str = "",
        check: Callable[[list[list], list[str], list[np.ndarray]], None] | None = None,
        fast: Callable[[list[str]], list[bytes | None]] | None = None, cache_bytes: int | None = None,
    ):
        self.fast, self.cache_bytes, self._size = fast, cache_bytes, 0
        self.encode_batch, self.joiner, self.plain_only, self.lead, self.check = encode_batch, joiner, plain_only, lead, check
        self.skip = len(encode_batch([lead])[0])
        self.mark = tuple(encode_batch([lead + joiner])[0][self.skip :])
        self.known: dict = {}
        self._before: dict = {}

    def learn(self, words: Iterable, as_text: Callable = lambda w: w) -> None:
        """See to it that `known` holds all of `words`; their keys are what `words` holds."""
        words = dict.fromkeys(words)
        if self._size > self.cache_bytes // 2 if self.cache_bytes else len(self.known) > CACHE_WORDS // 2:
            self._before, self.known, self._size = self.known, {}, 0
        known, before, missing = self.known, self._before, []
        for w in words:
            if w not in known:
                if w in before:
                    known[w] = before[w]
                    self._size += len(w) + len(before[w]) + 100
                else:
                    missing.append(w)
        if missing:
            found = self._ids(missing, [as_text(w) for w in missing])
            known.update(zip(missing, found))
            self._size += sum(map(len, missing)) + sum(map(len, found)) + 100 * len(missing)

    def _ids(self, words: list, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return self._joined_ids(words, texts)
        ids = self.fast(texts)
        rest = [i for i, x in enumerate(ids) if x is None]
        if rest:
            for i, x in zip(rest, self._joined_ids([words[i] for i in rest], [texts[i] for i in rest])):
                ids[i] = x
        return ids

    def _joined_ids(self, words: list, texts: list[str]) -> list[bytes]:
        alone = [i for i, t in enumerate(texts) if self.plain_only in t]
        together = [i for i, t in enumerate(texts) if self.plain_only not in t] if alone else list(range(len(texts)))
        ids: list[bytes] = [b""] * len(texts)
        for i, found in zip(alone, self.encode_batch([texts[i] for i in alone]) if alone else []):
            ids[i] = np.asarray(found, dtype="<u4").tobytes()
        groups = [together[a : a + _JOINED] for a in range(0, len(together), _JOINED)]
        joined = [self.lead + self.joiner.join([texts[i] for i in g]) for g in groups]
        flats = [np.asarray(found, dtype="<u4") for found in self.encode_batch(joined)]
        if self.check:
            self.check([[words[i] for i in g] for g in groups], joined, flats)
        size = len(self.mark)
        for group, flat in zip(groups, flats):
            hit = np.ones(max(0, len(flat) - size + 1), dtype=bool)
            hit[: self.skip] = False
            for k, m in enumerate(self.mark):
                hit &= flat[k : len(flat) - size + 1 + k] == m
            cuts = np.flatnonzero(hit)
            if len(cuts) != len(group) - 1:
                raise ValueError("The tokenizer does not keep apart what the joiner separates")
            raw, start = flat.tobytes(), self.skip
            for i, cut in zip(group, [*cuts.tolist(), len(flat)]):
                ids[i] = raw[4 * start : 4 * cut]
                start = cut + size
        return ids
