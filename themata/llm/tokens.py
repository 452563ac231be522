"""Token ids of whole texts with a public tokenizer file, remembered word by word.

Valid for tokenizers that drop white space before they look for words, so that no token spans it: the ids
of a text are those of its white-space separated parts, one after the other. A part of letters with marks
behind them is two words to the tokenizer, so letters and marks are looked up apart, and ASCII letters in
lower case as the tokenizer's normaliser has them. Most are found in a bounded cache of the Python worker.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from themata.llm.batches import Generations, Words, gather, ragged

#: Cached entries per generation and worker (about 30 MB each).
CACHED = 150_000

#: Words of letters encoded as one text; each ends with one word-final token, which parts them again.
JOINED = 256

#: Marks that the tokenizer parts from the letters before them. Not the apostrophe, which starts
#: contractions, and not the marks of special tokens.
MARKS = '.,!"#$%&()*+-/:;=?@[\\]^_`{}~'

#: The one letter whose lower case is not letters only: its dot joins the marks behind it, so that such a part
#: goes whole to the tokenizer.
DOTTED = "\u0130"

_encoders: dict[str, "Encoder"] = {}

def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)

class Encoder:
    """Ids of texts as the tokenizer file gives them without special tokens around."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters, self.others = Generations(CACHED), Generations(CACHED // 10)
        vocabulary = self.tokenizer.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.parted = rf"^(?P<letters>[^\PL{DOTTED}]+)(?P<marks>[{re.escape(MARKS)}]*)$"

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        made: list[bytes] = []
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for group, raw in zip(groups, self._encode([" ".join(g) for g in groups])):
            ends = (np.flatnonzero(self.final[np.frombuffer(raw, "<u4")]) + 1) * 4
            if len(ends) == len(group):
                made += [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            else:  # letters that the tokenizer splits, such as some whose lower case is longer
                made += self._encode(group)
        return made

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, little-endian unsigned 32 bit, and each text's number of ids."""
        words = Words(column)
        if not len(words.codes):
            return np.empty(0, "<u4"), np.diff(words.bounds)
        parts = pc.extract_regex(words.vocabulary, self.parted)
        
        letters = pc.ascii_lower(pc.fill_null(pc.struct_field(parts, "letters"), "")).dictionary_encode()
        marks = pc.coalesce(pc.struct_field(parts, "marks"), words.vocabulary).dictionary_encode()
        found = self.letters.values(letters.dictionary.to_pylist(), self._encode_letters)
        rest = self.others.values(marks.dictionary.to_pylist(), self._encode)
        # a part is its letters, then its marks; a part of another form stands whole in the second place
        both = np.stack([letters.indices.to_numpy(), marks.indices.to_numpy() + len(found)], axis=1).ravel()
        flat, starts, lengths = ragged(found + rest, "<u4")
        flat, ends = gather(flat, starts, lengths, both)
        ends = ends[1::2]
        lengths = np.diff(ends, prepend=0)
        ids, ends = gather(flat, ends - lengths, lengths, words.codes)
        return ids, np.diff(np.concatenate(([0], ends))[words.bounds])

def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
