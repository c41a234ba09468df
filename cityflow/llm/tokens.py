"""Token ids of whole texts by a public byte-level tokenizer."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken

#: Fixed value: how a byte-level tokenizer cuts a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space as the pattern has it: Unicode's, without the separators that Python counts as well.
_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space from this length on are cut here, as the pattern goes back over a run and ends in an error on very long ones.
LONG_RUN = 10_000
_LONG = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a tokenizer file, once for each worker.

    The file's merges must be in the order of the ids they make, as they are where merging by rank and by
    list are the same; other files are refused.
    """
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    model = described["model"]
    before = described["pre_tokenizer"]
    plain = described.get("normalizer") is None and before["type"] == "ByteLevel" and before.get("use_regex", True)
    if model["type"] != "BPE" or not plain or before["add_prefix_space"]:
        raise ValueError(f"{path} is not a byte-level tokenizer")
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    byte_of = _byte_letters()
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    if any(re.search(f"[{_SPACE}]", t) for t in special):
        raise ValueError(f"special tokens of {path} hold white space")
    ranks = {bytes(map(byte_of.__getitem__, word)): i for word, i in model["vocab"].items() if word not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _cut(text: str, special: set[str]) -> Iterator[tuple[str, bool]]:
    """A text in parts that the pattern would cut as well, and whether a part is a long run of white space.

    The pattern takes a run whole at the end of a text or before a special token, and else all but its last character.
    """
    done = 0
    for run in _LONG.finditer(text):
        whole = run.end() == len(text) or text.startswith(tuple(special), run.end())
        yield text[done : run.start()], False
        done = run.end() if whole else run.end() - 1
        yield text[run.start() : done], True
    yield text[done:], False


def _ids(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    special = encoder.special_tokens_set
    parts = [
        np.array(encoder._core_bpe.encode_single_piece(part.encode()), dtype="<u4")
        if run
        else encoder.encode_to_numpy(part, allowed_special="all")
        for part, run in _cut(text, special)
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit; special tokens in a text are read as such."""
    encoder = encoding(path)
    return [_ids(encoder, t).astype(np.dtype("<u4")).tobytes() for t in texts]
