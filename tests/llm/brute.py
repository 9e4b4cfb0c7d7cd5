"""Plain versions of the operators, over lists of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def ids_crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def lines(docs):
    keys = defaultdict(set)
    split = {}
    for doc_id, text in docs:
        split[doc_id] = [(x, x.strip(" \t\n\x0b\x0c\r").translate(UPPER)) for x in (text or "").split("\n")]
        for _, key in split[doc_id]:
            if len(key) >= 10:
                keys[key].add(doc_id)
    out = {}
    for doc_id, rows in split.items():
        kept = [x for x, k in rows if len(keys[k]) < 2 or min(keys[k]) == doc_id]
        out[doc_id] = (len(rows), len(rows) - len(kept), "\n".join(kept))
    return out


def substrings(docs, size):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            window = data[p : p + size]
            if window in seen:
                gone[p : p + size] = b"\x01" * size
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def words_of_search(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def hits(docs, items, size=10):
    out = {}
    for doc_id, text in docs:
        own = words(text)
        hit, names = set(), set()
        for item_id, item in items:
            item = words(item)
            length = min(size, len(item))
            for w in {tuple(item[i : i + length]) for i in range(len(item) - length + 1)} if length else ():
                for i in range(len(own) - length + 1):
                    if tuple(own[i : i + length]) == w:
                        hit.update(range(i, i + length))
                        names.add(str(item_id))
        out[doc_id] = (len(own), len(hit), len(names), sha(",".join(sorted(names))))
    return out


def shingles(text, size=5):
    own = words(text)
    if not own:
        return set()
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))}


def near_classes(docs, similar=0.8):
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= similar:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc_id: find(doc_id) for doc_id in ids}
