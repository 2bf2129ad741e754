"""Token ids of whole texts with the tokenizers library, inside Spark tasks."""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterable

import numpy as np

# Words whose ids a Python worker remembers; others are encoded again when they come again.
REMEMBERED = 400_000
# White space next to white space, in texts that are therefore encoded whole, and marks that end words.
RUNS = ["  ", "\n\n", " \n", "\n "]
MARKS = [".", ",", ";", ":", "!", "?"]
# Texts are handled in slices of about so many characters, so that memory does not follow the size of Arrow batches.
SLICE = 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to those of encoding each whole text.

    A byte-level BPE starts a new pre-token at a space or line end between solid characters, whatever stands around. Texts
    are cut there, pieces met before are looked up, and the rest are encoded by the library many at a time. Texts with runs
    of white space, with a special token's string, and all texts of tokenizers of another build are encoded whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor already share its cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_words = bool(byte_level and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding"))
        self.whole = [t["content"] for t in spec.get("added_tokens", [])] + RUNS
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.spaced = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("\u0120")
        self.remembered = remembered
        self.line_end, space, *marks = self._each(["\n", " ", *MARKS])
        self.marks = dict(zip(MARKS, marks))
        self.line_ends = np.zeros(self.size, bool)
        self.line_ends[np.frombuffer(self.line_end, "<u4")] = True
        self.known = {"": space, "\n": self.line_end}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, glue: str, part: list[str], starts: np.ndarray) -> None:
        """Ids of pieces joined by a glue that begins each, cut where a token is one that starts a piece."""
        ids = np.array(self.tokenizer.encode_batch_fast([glue + glue.join(part)], add_special_tokens=False)[0].ids, "<u4")
        bounds = [*np.flatnonzero(starts[ids]).tolist(), len(ids)]
        keys = part if glue == " " else [glue + w for w in part]
        if len(bounds) != len(part) + 1:
            self.known.update(zip(keys, self._each([glue + w for w in part])))
            return
        data = ids.tobytes()
        self.known.update((w, data[4 * b:4 * e]) for w, b, e in zip(keys, bounds, bounds[1:]))

    def _learn(self, new: set[str]) -> None:
        """Ids of unseen pieces: those that begin with a line end, and those that a space stands before."""
        plain, marked, heads = [], [], []
        for w in new:
            if w[0] == "\n":
                heads.append(w[1:])
            # A mark after a letter is a pre-token of its own.
            elif len(w) > 1 and w[-1] in self.marks and w[-2].isalpha():
                marked.append(w)
            else:
                plain.append(w)
        known, marks = self.known, self.marks
        plain += {w[:-1] for w in marked}.difference(known, plain)
        for at in range(0, len(plain), 4096):
            self._joined(" ", plain[at:at + 4096], self.spaced)
        for at in range(0, len(heads), 4096):
            self._joined("\n", heads[at:at + 4096], self.line_ends)
        for w in marked:
            known[w] = known[w[:-1]] + marks[w[-1]]

    def _slice(self, texts: list[str]) -> list[bytes]:
        known = self.known
        kept, flat, ends = len(known), [], []
        for t in texts:
            if self.by_words and not any(s in t for s in self.whole):
                flat += ("\n" + t).replace("\n", " \n").split(" ")[1:]
            ends.append(len(flat))
        found = list(map(known.get, flat))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        new = {flat[i] for i in gaps}
        # Other white space at the edge of a piece could be part of a run.
        unsafe = {w for w in new if w[-1].isspace() or w[w[0] == "\n"].isspace()}
        self._learn(new - unsafe)
        for i in gaps:
            found[i] = known.get(flat[i])
        out, at, skip = [], 0, len(self.line_end)
        for t, end in zip(texts, ends):
            parts = found[at:end]
            out.append(self._each([t])[0] if at == end or unsafe and None in parts else b"".join(parts)[skip:])
            at = end
        if len(known) > self.remembered:
            for w in list(itertools.islice(reversed(known), len(known) - max(kept, self.remembered))):
                del known[w]
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        """Ids of each text in turn; a null text is empty."""
        part, chars = [], 0
        for text in texts:
            part.append(text or "")
            chars += len(part[-1])
            if chars >= SLICE:
                yield from self._slice(part)
                part, chars = [], 0
        yield from self._slice(part)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a Python worker, kept from task to task."""
    return Encoder(path)
