"""Token ids of whole texts by a byte-level BPE tokenizer."""

import json
import re

import numpy as np

#: Characters of a text encoded at a time, about.
STRETCH = 1 << 16

# The pattern by which byte-level tokenizers of this kind cut a text before they merge bytes, and the
# characters that the pattern may take for white space, other than those of ASCII.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER_WHITE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
# End of the fixed values.

_WHITE = " \t\n\r\x0b\x0c"
_BREAK = re.compile(f"(?<=[^{_WHITE}])[{_WHITE}]")


def _bytes_of() -> dict[str, int]:
    """The byte that each character of a vocabulary entry stands for: printable ones for themselves, the others in order
    from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The entries' bytes and ids, if the ids are the order in which pairs are merged, as a fast encoder needs it."""
    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    model, cut = description["model"], description.get("pre_tokenizer") or {}
    special = {t["content"] for t in description.get("added_tokens", ())}
    if model.get("type") != "BPE" or description.get("normalizer") or cut.get("type") != "ByteLevel":
        return None
    if cut.get("add_prefix_space") or cut.get("use_regex") is False or model.get("dropout") or model.get("unk_token"):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or len(vocabulary) != 256 + len(pairs):
        return None
    byte = _bytes_of()
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, equal to those of the tokenizer in the file.

    Where the file describes plain byte-pair merging, the same merges are run by tiktoken, which is several times as fast
    for words that come for the first time. The tokenizer itself takes what that library cannot, and texts that hold the
    string of an added token. With ``plain`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if t.content and not (plain and t.special)]
        ranks = _ranks(path)
        self.fast = ranks and tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(content in text for content in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(self._encoded(part) for part in stretches(text))

    def _encoded(self, text: str) -> bytes:
        ids = None
        if self.fast:
            try:
                ids = self.fast.encode_ordinary(text)
            except (KeyboardInterrupt, SystemExit, MemoryError):
                raise
            except BaseException:  # a panic of the library, as over very long runs of white space
                ids = None
        if ids is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def stretches(text: str):
    """The text in parts that are encoded as they are within it: cut before white space, where no token goes on.

    A text with other white space than that of ASCII is one part.
    """
    if len(text) <= STRETCH or _OTHER_WHITE.search(text):
        yield text
        return
    at = 0
    while len(text) - at > STRETCH:
        cut = _BREAK.search(text, at + STRETCH)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; empty for ids without an entry and for special tokens."""
    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    byte, special = _bytes_of(), {t["content"] for t in description.get("added_tokens", ()) if t.get("special")}
    vocabulary = description["model"]["vocab"]
    out = [b""] * (max([*vocabulary.values(), *(t["id"] for t in description.get("added_tokens", ()))]) + 1)
    for token, i in vocabulary.items():
        out[i] = b"" if token in special else bytes(byte[c] for c in token)
    return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder for the file."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]
