"""Token ids of many texts at once, through a public tokenizer's own library.

Texts are cut before spaces. Both tokenizer kinds here split words at white space before they
merge, so the pieces of a text can be encoded one by one; each different piece is encoded once
and remembered, and the ids of all texts are then put together by array operations.
"""

from __future__ import annotations

import os
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces that an encoder remembers, characters handled at a time, and pieces that the library gets at
# a time, whose results are large objects: bounds on memory only.
REMEMBERED, CHARS_AT_ONCE, LIBRARY_AT_ONCE = 400_000, 4_000_000, 5_000
# Stands between pieces that the library gets as one text: a control character, a word by itself.
MARK = "\x01"
# Marks at the end of a word that both tokenizer kinds split off and that compose with no other character.
TAIL = ".,;:!?#$%&*|"


def worker_memo(name: str) -> dict:
    """A dict that lives as long as the Python worker, which runs many tasks.

    Functions here travel by value and bring their own globals along for every task, so the memo
    hangs on a module that is made in the worker.
    """
    module = sys.modules.setdefault("standings_llm_memo", types.ModuleType("standings_llm_memo"))
    return module.__dict__.setdefault(name, {})


class TextEncoder:
    """``encode`` equals the library's ``encode_batch(texts, add_special_tokens=False)``.

    ``spaces`` says that a space belongs to the word after it (byte-level BPE); otherwise white
    space is dropped. The string of a special token in a text gives the special id, as in the
    library; texts that hold one go through uncut. The tokenizer stays with the Python worker; the
    remembered pieces stay too if ``stay``, else they go with the encoder.
    """

    def __init__(self, path: str, spaces: bool, stay: bool = False):
        from tokenizers import Tokenizer

        # Tasks run side by side already; threads of the library would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memo = worker_memo(path)
        if not memo:
            memo["tokenizer"] = Tokenizer.from_file(path)
        self.tokenizer, self.known = memo["tokenizer"], memo.setdefault("known", {}) if stay else {}
        self.spaces = spaces
        self.lead, self.mark = (" ", " " + MARK) if spaces else ("", f" {MARK} ")
        self.mark_ids = self._alone([self.mark])[0]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _alone(self, texts: list[str]) -> list[bytes]:
        """The ids of each text by itself."""
        out = []
        for at in range(0, len(texts), LIBRARY_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + LIBRARY_AT_ONCE], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    def _together(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that follow a space, as one text with marks between them."""
        text = self.mark.join([self.lead + p for p in pieces])
        if text.count(MARK) != len(pieces) - 1:
            return self._alone([self.lead + p for p in pieces])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        # A mark is one id, or one after that of its space.
        own = len(self.mark_ids) // 4
        cuts = np.flatnonzero(ids == np.frombuffer(self.mark_ids, "<u4")[-1])
        ends = (4 * np.append(cuts + 1 - own, len(ids))).tolist()
        begins = (4 * np.append(0, cuts + 1)).tolist()
        raw = ids.tobytes()
        return [raw[b:e] for b, e in zip(begins, ends)]

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that follow a space.

        Marks that follow a letter at the end of a piece are a word by themselves, so only what
        stands before them is remembered. Letters beyond Latin Extended-B, on which Unicode
        versions may differ, are left with their marks.
        """
        ids = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(ids) if x is None]
        bodies, tails = [], []
        for i in new:
            piece = pieces[i]
            body = piece.rstrip(TAIL)
            if body and len(body) < len(piece) and body[-1] < "\u0250" and body[-1].isalpha():
                bodies.append(body)
                tails.append(piece[len(body) :])
            else:
                bodies.append(piece)
                tails.append("")
        found = {body: self.known.get(body) for body in bodies}
        asked = [body for body, x in found.items() if x is None]
        for at in range(0, len(asked), LIBRARY_AT_ONCE):
            part = asked[at : at + LIBRARY_AT_ONCE]
            found.update(zip(part, self._together(part)))
        for body in asked[: max(0, REMEMBERED - len(self.known))]:
            self.known[body] = found[body]
        ends = list(dict.fromkeys(tails))
        end_ids = dict(zip(ends, self._alone(ends)))
        for i, body, tail in zip(new, bodies, tails):
            ids[i] = found[body] + end_ids[tail] if tail else found[body]
        return ids

    def _uncut(self, texts: list[str]) -> list[bool]:
        """Whether a text goes through the library whole: it holds a special token's string, or a
        longer run of spaces where these are tokens of their own kind."""
        found = [self.spaces and "  " in t for t in texts]
        for content in self.special:
            found = [f or content in t for f, t in zip(found, texts)]
        return found

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text starts, with the total last."""
        whole = [t or "" for t in texts]
        if not self.spaces:
            whole = [" ".join(t.split("\n")) if "\n" in t else t for t in whole]
        uncut = self._uncut(whole)
        parts = pc.split_pattern(pa.array(["" if u else t for t, u in zip(whole, uncut)], pa.large_string()), " ")
        flat = pc.list_flatten(parts).dictionary_encode()
        offsets = np.asarray(parts.offsets)
        codes = flat.indices.to_numpy(zero_copy_only=False).copy()
        pieces = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.spaces:
            # The first piece of a text has no space before it.
            first = offsets[:-1]
            heads = [pieces[c] for c in codes[first]]
            extra = {h: len(pieces) + i for i, h in enumerate(dict.fromkeys(heads))}
            codes[first] = [extra[h] for h in heads]
            ids = self._ids_of(pieces) + self._alone(list(extra))
        else:
            ids = self._ids_of(pieces)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        table = np.frombuffer(b"".join(ids), "<u4")
        many = size[codes]
        ends = np.concatenate(([0], np.cumsum(many)))
        place = np.repeat((start[codes] - ends[:-1]).astype(np.int32), many)
        place += np.arange(ends[-1], dtype=np.int32)
        out, starts = table[place], ends[offsets]
        if any(uncut):
            alone = iter(self._alone([t for t, u in zip(whole, uncut) if u]))
            each = [np.frombuffer(next(alone), "<u4") if u else out[starts[i] : starts[i + 1]] for i, u in enumerate(uncut)]
            starts = np.concatenate(([0], np.cumsum([len(e) for e in each])))
            out = np.concatenate(each)
        return out, starts


def documents_of(batch: pa.RecordBatch, encoder: TextEncoder) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the rows of ``batch`` (doc_id, text), about ``CHARS_AT_ONCE`` characters at a time."""
    sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy()
    turn = np.cumsum(sizes) // CHARS_AT_ONCE
    begins = np.flatnonzero(np.diff(turn, prepend=-1))
    for begin, end in zip(begins, [*begins[1:], len(batch)]):
        part = batch.slice(begin, end - begin)
        flat, starts = encoder.encode(part.column("text").to_pylist())
        for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
            yield doc_id, flat[starts[i] : starts[i + 1]]
