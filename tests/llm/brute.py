"""Plain forms of the training-data operators, to hold the Spark results against."""

import base64
import hashlib
import re
from collections import defaultdict

import public_tokenizers


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def edited(docs):
    """doc_id to the edited text."""
    down = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc, text) in enumerate(down):
        text, after = text or "", down[(i + 1) % len(down)][1] or ""
        half = len(text) // 2
        out[doc] = text[: len(text) - half] + after[:half]
    return out


def shingles(text, width, lower=False):
    text = text or ""
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)
    if not found:
        return set()
    if len(found) < width:
        return {tuple(found)}
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def near_duplicates(docs, width=4, percent=80):
    """doc_id to (n_shingles, component)."""
    sets = {d: shingles(t, width, lower=True) for d, t in docs}
    least = {d: d for d in sets}

    def root(x):
        while least[x] != x:
            least[x] = least[least[x]]
            x = least[x]
        return x

    holders, first = defaultdict(list), {}
    for d in sorted(sets):
        key = frozenset(sets[d])
        if key and key in first:
            least[root(d)] = root(first[key])
            continue
        first[key] = d
        if not key:
            continue
        shared = defaultdict(int)
        for s in key:
            for other in holders[s]:
                shared[other] += 1
            holders[s].append(d)
        for other, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((root(d), root(other)))
                least[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def substrings(docs, window=50):
    """doc_id to (n_words, n_removed, kept words)."""
    first = {}
    split = {d: words(t) for d, t in docs}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - window + 1):
            first.setdefault(hash(tuple(w[i : i + window])), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[hash(tuple(w[i : i + window]))] < d:
                gone.update(range(i, i + window))
        out[d] = len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]
    return out


def bpe():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sentences():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def auc(scores, labels):
    ranked = sorted(zip(scores, labels, strict=True))
    good = sum(y for _, y in ranked)
    total, i = 0.0, 0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        total += sum(y for _, y in ranked[i:j]) * (i + j + 1) / 2
        i = j
    return (total - good * (good + 1) / 2) / max(1, good * (len(ranked) - good))
