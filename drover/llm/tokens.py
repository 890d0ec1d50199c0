"""Token ids of whole texts, with a bounded per-process cache of words.

The word tokenizer lower-cases, drops white space and never joins letters across it, so
the ids of a text are the ids of its white-space separated chunks, one after another. Arrow
splits the texts of a call and numbers their distinct chunks; the cache holds the ids of
chunks, and what it lacks goes to the tokenizer in one call. Texts outside the characters
for which this is exact go to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks of a generation of the cache (about 200 bytes each). A process keeps two: what was
#: not looked up while a generation filled goes with the next.
CACHE = 100_000
#: Text for one call of ``Tokens.encode``: the more of it, the fewer chunks are looked up twice.
CALL_BYTES = 8 << 20
#: Rows of an Arrow batch that is about one call.
CALL_ROWS = 4_000
#: Chunks that are learnt, and words whose ids are laid out, at once: what a call holds
#: beside its text and its ids.
BLOCK = 20_000
#: Beyond Latin letters, normal forms and lower-casing need the tokenizer's own rules;
#: the separators 0x1C-0x1F are white space to Python alone.
_OTHER = re.compile("[^\x00-\x1b\x20-įı-ɏ]")
#: The Latin letters, and what they are in lower case (Ɓ: ɓ).
_LATIN = sorted({c for k in range(0x250) if not _OTHER.match(chr(k)) for c in (chr(k), chr(k).lower())})


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _LATIN if unicodedata.category(c).startswith(kind))


_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_SPACE}{_class('L')}{_class('N')}]+")
_loaded: dict[str, "Tokens"] = {}


class Tokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        spec = json.loads(self.whole.to_str())
        splits = [p.get("pattern", {}).get("Regex", "") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.by_word = spec["model"]["type"] == "BPE" and spec["model"].get("end_of_word_suffix") == "</w>" and \
            kinds == ["NFC", "Replace", "Lowercase"] and any(s.startswith("'s|'t|") and s.endswith(r"[^\s\p{L}\p{N}]+") for s in splits)
        if self.by_word:
            self.words = Tokenizer.from_str(self.whole.to_str())
            self.words.encode_special_tokens = True
            self.words.normalizer = normalizers.Sequence([])
            self.words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
            self.cache: dict[str, bytes] = {}    # chunks, and the pieces that chunks are cut into
            self.older: dict[str, bytes] = {}    # the generation before

    def _lacking(self, words: Iterable[str]) -> list[str]:
        """Those of ``words`` that neither generation has; what the older one has is kept."""
        lacking = []
        for w in words:
            ids = self.older.get(w)
            if ids is None:
                lacking.append(w)
            else:
                self.cache[w] = ids
        return lacking

    def _learn(self, chunks: list[str]) -> None:
        """Put chunks into the cache; a chunk of letters is a piece, others are cut."""
        cut = {c: _PIECES.findall(c) for c in chunks if not c.isalpha()}
        new = {p for ps in cut.values() for p in ps if p not in self.cache}
        pieces = [c for c in chunks if c not in cut]
        pieces += self._lacking(new.difference(pieces))
        if pieces:
            lots = [" ".join(pieces[i:i + 100]) for i in range(0, len(pieces), 100)]
            ids = np.concatenate([e.ids for e in self.words.encode_batch_fast(lots, add_special_tokens=False)]).astype("<u4")
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(pieces):
                raise ValueError("the tokenizer's words do not end in its end-of-word tokens")
            raw, at = ids.tobytes(), [0, *((last + 1) * 4).tolist()]
            self.cache.update((p, raw[a:b]) for p, a, b in zip(pieces, at, at[1:], strict=False))
        for c, ps in cut.items():
            if len(ps) != 1 or ps[0] != c:
                self.cache[c] = b"".join([self.cache[p] for p in ps])

    def _by_word(self, texts: list[str]) -> Iterator[bytes]:
        words = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
        offsets, numbered = words.offsets.to_numpy(), words.values.dictionary_encode()
        del words
        chunks, number = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        del numbered
        if len(self.cache) > CACHE:
            self.older, self.cache = self.cache, {}
        found = list(map(self.cache.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        lacking = self._lacking(chunks[i] for i in new)
        for i in range(0, len(lacking), BLOCK):
            self._learn(lacking[i:i + BLOCK])
        for i in new:
            found[i] = self.cache[chunks[i]]
        del chunks, new, lacking
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, ids = np.cumsum(size) - size, np.frombuffer(b"".join(found), "<u4")
        del found
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
            part = number[offsets[i]:offsets[j]]
            sizes = size[part]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            # an id is as far from the first of its chunk as from the first of its word
            raw = ids[np.arange(ends[-1]) + np.repeat(first[part] - ends[:-1], sizes)].tobytes()
            bounds = (4 * ends[offsets[i:j + 1] - offsets[i]]).tolist()
            yield from (raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False))
            i = j

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: none) as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = [b""] * len(texts)
        odd, plain = [], []
        for i, t in enumerate(texts):
            if t:
                (plain if self.by_word and not _OTHER.search(t) else odd).append(i)
        if odd:
            for i, e in zip(odd, self.whole.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        if plain:
            for i, ids in zip(plain, self._by_word([texts[i] for i in plain]), strict=True):
                out[i] = ids
        return out


def tokens(path: str) -> Tokens:
    """The tokenizer at ``path``, loaded once per process."""
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]
