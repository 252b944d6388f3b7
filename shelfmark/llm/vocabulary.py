"""A byte-level BPE vocabulary read from a public tokenizer file."""

import json
import re
import unicodedata

import numpy as np
import regex

# The pattern that splits text before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.iinfo(np.int64).max


def read_model(path):
    """The text of a tokenizer file on the driver. It is a vocabulary: some MB at most."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _printable_bytes():
    """Byte-level vocabularies write each byte as one printable character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(byte): byte for byte in shown}
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return table | {chr(256 + k): byte for k, byte in enumerate(hidden)}


def _plane_pattern():
    """The pattern for texts of the basic plane, with classes spelled out: several times as fast."""
    ranges = {"L": [], "N": []}
    for point in range(0x10000):
        own = ranges.get(unicodedata.category(chr(point))[0])
        if own is None:
            continue
        if own and own[-1][1] == point - 1:
            own[-1][1] = point
        else:
            own.append([point, point])
    text = {
        kind: "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in own) for kind, own in ranges.items()
    }
    # The code points of Unicode's White_Space.
    blank = r"\u0009-\u000d\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{text['L']}]+| ?[{text['N']}]+"
        rf"| ?[^{blank}{text['L']}{text['N']}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class Vocabulary:
    """Tokens as bytes, and for each token the merge that makes it.

    `rank` is -1 for a single byte; `left` and `right` are the two tokens a merge joins.
    """

    def __init__(self, model_text):
        spec = json.loads(model_text)
        _check(spec)
        shown = _printable_bytes()
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        names = {name: k for name, k in spec["model"]["vocab"].items() if name not in self.special}
        size = 1 + max([*names.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for name, k in names.items():
            self.token_bytes[k] = bytes(shown[c] for c in name)
        for content, k in self.special.items():
            self.token_bytes[k] = content.encode()
        self.id_of = {self.token_bytes[k]: k for k in names.values()}
        self.byte_id = [self.id_of[bytes([byte])] for byte in range(256)]
        self.size = size
        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.merge = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = names[a], names[b], names[a + b]
            if self.rank[whole] >= 0:
                raise ValueError("two merges make the same token")
            self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
            self.merge[a, b] = (rank, whole)
        self._pairs = np.array([a * size + b for a, b in self.merge], np.int64)
        self._pair_ranks = np.arange(len(self._pairs), dtype=np.int64)
        order = np.argsort(self._pairs)
        self._pairs, self._pair_ranks = self._pairs[order], self._pair_ranks[order]
        self.longest = {}
        for token in self.id_of:
            for k in (1, 2, 3):
                head = token[:k]
                self.longest[head] = max(self.longest.get(head, 0), len(token))
        self.splitter = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len)[::-1])) + ")")
            if self.special
            else None
        )
        self._words = regex.compile(PATTERN).findall
        self._plane_words = _plane_pattern().findall

    def words(self, text):
        """The words that are merged each on its own."""
        if not text:
            return []
        return self._plane_words(text) if max(text) <= "\uffff" else self._words(text)

    def parts(self, text):
        """The text cut at special tokens; odd positions hold those tokens."""
        return self.splitter.split(text) if self.splitter else [text]

    def pair_rank(self, a, b):
        """Rank of the merge of each pair of two arrays, or NEVER."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._pair_ranks[at], NEVER)

    def compatible(self, a, b):
        """Whether each pair of tokens stays as it is when their bytes are merged together.

        Undoes merges from the last to the first. At each point in time the two tokens at the
        border must not have a merge that would have come earlier. Of equal ranks the left one
        comes first.
        """
        left, right = np.array(a, np.int64), np.array(b, np.int64)
        fits = np.ones(len(left), bool)
        limit = np.full(len(left), NEVER)
        live = np.arange(len(left))
        while len(live):
            l, r = left[live], right[live]
            crossed = self.pair_rank(l, r) < limit[live]
            fits[live[crossed]] = False
            l_rank, r_rank = self.rank[l], self.rank[r]
            go_on = ~crossed & ((l_rank >= 0) | (r_rank >= 0))
            live, l, r = live[go_on], l[go_on], r[go_on]
            l_rank, r_rank = l_rank[go_on], r_rank[go_on]
            undo_left = l_rank > r_rank
            limit[live] = np.where(undo_left, l_rank, r_rank + 1)
            left[live] = np.where(undo_left, self.right[l], l)
            right[live] = np.where(undo_left, r, self.left[r])
        return fits


def _check(spec):
    pre = spec.get("pre_tokenizer") or {}
    model = spec["model"]
    plain = (
        model["type"] == "BPE"
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not spec.get("normalizer")
        and not model.get("ignore_merges")
        and not any(
            token[flag]
            for token in spec["added_tokens"]
            for flag in ("single_word", "lstrip", "rstrip", "normalized")
        )
    )
    if not plain:
        raise ValueError("only plain byte-level BPE files are supported")


_LOADED = {}


def shared_vocabulary(broadcast):
    """One Vocabulary for each Python worker and broadcast file."""
    key = hash(broadcast.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(broadcast.value)
    return _LOADED[key]
