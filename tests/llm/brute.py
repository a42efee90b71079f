"""Plain versions of the operators' rules, for small tables."""

import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def fold(text):
    return (text or "").translate(FOLD)


def words(text):
    return WORD.findall(fold(text))


def shingles(text):
    ws = words(text)
    if not ws:
        return set()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}


def components(rows):
    """{id: smallest id reachable} over pairs with 100 * shared >= 75 * union."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in ids}


def spans(rows, least=50):
    """{(id, start, end)}: words covered by a stretch of ``least`` words that another id has."""
    where = defaultdict(set)
    texts = {i: words(t) for i, t in rows}
    for i, ws in texts.items():
        for at in range(len(ws) - least + 1):
            where[tuple(ws[at : at + least])].add(i)
    out = set()
    for i, ws in texts.items():
        begin = end = None
        for at in range(len(ws) - least + 1):
            if len(where[tuple(ws[at : at + least])]) > 1:
                if begin is not None and at > end:
                    out.add((i, begin, end))
                    begin = None
                begin = at if begin is None else begin
                end = at + least
        if begin is not None:
            out.add((i, begin, end))
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
