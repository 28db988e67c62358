"""Whole-text encoding by a byte-level BPE file of the ``tokenizers`` library, with that library's own ids.

The ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``, untouched: an added
token's string in a text becomes that token (``specials_as_text`` makes it ordinary text instead).

Where it is certain to give the same ids, the work is done by ``tiktoken``, whose loop merges the neighbours whose bytes together are
the token of the smallest rank, while the library merges the listed pair of the smallest rank. They agree if ids rise with the
rank of the merge and every token of the vocabulary encodes to itself: two neighbours that make up a token have been
merged as they would be in that token alone, and there the last two left are the listed pair. Both are checked on loading.

Texts that hold an added token, characters whose class may differ between versions of Unicode, or blanks too long for the pattern go
through the library as a whole, as do all texts of a file of another kind or one that fails the checks.

Defined cases: null and empty texts have no ids; very long texts and words are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable

from setlake.llm.common import give_back, worker_cache

#: The public byte-level pattern (fixed value), and the texts it is trusted on: Latin ones without disputed control characters or very long blanks.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN, LONG_BLANKS = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*+"), 5000
_BLANKS = re.compile(rf"\s{{{LONG_BLANKS}}}")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a file as ranks by bytes, if they are sure to give its ids."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    pre, model = given["pre_tokenizer"] or {}, given["model"]
    known = not given["normalizer"] and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not known or not plain or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"]):
        return None
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    byte = {c: b for b, c in byte_letters().items()}
    bare = Tokenizer.from_file(path)
    bare.pre_tokenizer = None
    bare.encode_special_tokens = True
    tokens = list(vocabulary)
    alone = all(e.ids == [vocabulary[t]] for t, e in zip(tokens, bare.encode_batch_fast(tokens, add_special_tokens=False), strict=True))
    if made != sorted(set(made)) or not alone or not byte.keys() <= vocabulary.keys() or not set("".join(tokens)) <= byte.keys():
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}


@worker_cache
def encoder(path: str, specials_as_text: bool = False) -> Callable[[list[str | None]], list[bytes]]:
    """A function from texts (null: empty) to ids, little-endian unsigned 32-bit integers, for a ``tokenizers`` JSON file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    if sys.byteorder != "little" or array("I").itemsize != 4:
        raise RuntimeError("ids are written as little-endian 32-bit integers")
    whole, ranks = Tokenizer.from_file(path), _ranks(path)
    whole.encode_special_tokens = specials_as_text
    added = [] if specials_as_text else [t.content for t in whole.get_added_tokens_decoder().values()]
    fast = ranks and tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    give_back()  # loading takes much that stays free

    def sure(text: str) -> bool:
        return bool(fast and _PLAIN.fullmatch(text)) and not any(a in text for a in added) and (len(text) < LONG_BLANKS or not _BLANKS.search(text))

    def encode(texts: list[str | None]) -> list[bytes]:
        out = [array("I", fast(t)).tobytes() if sure(t) else None for t in (t or "" for t in texts)]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, whole.encode_batch_fast([texts[i] or "" for i in rest], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    return encode


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
