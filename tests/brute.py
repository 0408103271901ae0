"""The rules in plain Python on small inputs, to compare Spark results with."""

from collections import Counter

import regex

# Fixed value: the pretoken pattern.
PATTERN = regex.compile(
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def pretokens(text, specials=()):
    if not specials:
        return PATTERN.findall(text)
    longest_first = sorted(specials, key=len, reverse=True)
    parts = regex.split("(" + "|".join(map(regex.escape, longest_first)) + ")", text)
    return [p for part in parts for p in ([part] if part in specials else PATTERN.findall(part))]


def merge(word, pair):
    out, i = [], 0
    while i < len(word):
        if word[i : i + 2] == pair:
            out.append(pair[0] + pair[1])
            i += 2
        else:
            out.append(word[i])
            i += 1
    return tuple(out)


def as_word(pretoken):
    return tuple(bytes([b]) for b in pretoken.encode())


def train(texts, num_merges, specials=()):
    words = Counter(as_word(p) for t in texts for p in pretokens(t, specials))
    merges = []
    while len(merges) < num_merges:
        pairs = Counter()
        for word, n in words.items():
            for pair in zip(word, word[1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = max(pairs, key=lambda p: (pairs[p], p))
        merges.append(best)
        words = Counter({merge(w, best): n for w, n in words.items()})
    return merges


def encode(text, vocab, merges, specials=()):
    """`vocab` is id -> bytes, with the specials in it."""
    ids_of = {token: i for i, token in vocab.items()}
    out = []
    for pretoken in pretokens(text, specials):
        if pretoken in specials:
            out.append(ids_of[pretoken.encode()])
            continue
        word = as_word(pretoken)
        for pair in merges:
            word = merge(word, pair)
        for symbol in word:
            if symbol in ids_of:
                out.append(ids_of[symbol])
            else:
                out += [ids_of[bytes([b])] for b in symbol if bytes([b]) in ids_of]
    return out


def hexes(merges):
    return [(left.hex().upper(), right.hex().upper()) for left, right in merges]
