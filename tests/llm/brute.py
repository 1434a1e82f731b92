"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Budgets by sharing what capped sources leave again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            return found | {s: left * weight[s] / total for s in open_}
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]
        open_ -= over
    return found


def kept_lines(docs):
    """{doc_id: (n_lines, n_dropped, sha256)} by the rule on repeated lines."""
    key = lambda line: lower(line.strip(SPACE))
    first, count = {}, defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            count[key(line)].add(doc_id)
    for k, ids in count.items():
        first[k] = min(ids)
    found = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(count[key(x)]) < 2 or first[key(x)] == doc_id]
        found[doc_id] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return found


def shingle_set(text, size):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(docs, size, per_cent):
    sets = {doc_id: shingle_set(text, size) for doc_id, text in docs}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= per_cent * (len(sets[a]) + len(sets[b]) - shared):
                    links.append((a, b))
    found = roots(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def without_repeats(docs, size):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)} by counting every string of `size` bytes."""
    raw = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    count = Counter(data[i : i + size] for _, data in raw for i in range(len(data) - size + 1))
    found = {}
    for doc_id, data in raw:
        gone = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - size + 1):
            if count[data[i : i + size]] > 1:
                gone[i : i + size] = True
        gone = gone[:-1]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        found[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return found


def vector_links(vectors, least):
    """{vec_id: (n_links, component_id, kept)} by all cosines."""
    ids = [i for i, _ in vectors]
    sound = {
        i: np.array(v, float) for i, v in vectors
        if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))
    }
    links = []
    for a in sound:
        for b in sound:
            if b < a and sound[a] @ sound[b] / np.linalg.norm(sound[a]) / np.linalg.norm(sound[b]) >= least:
                links.append((a, b))
    found = roots(ids, links)
    counts = Counter(x for pair in links for x in pair)
    return {i: (counts[i], found[i], found[i] == i) for i in ids}


def pieces(docs, tokenizer, capacity):
    found = {}
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            found[doc_id, k // capacity] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return found


def digest(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def leaf(values):
    return digest(b"".join(b"-" if v is None else b"%d:%s" % (len(b := str(v).encode()), b) for v in values))


def tree(nodes, fanout):
    """The top over nodes, and for each the siblings and slots on its way there."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            low = place - place % fanout
            paths[k].append((place - low, nodes[low:place] + nodes[place + 1 : low + fanout]))
            at[k] = place // fanout
        nodes = [digest("".join(nodes[low : low + fanout])) for low in range(0, len(nodes), fanout)]
    return nodes[0], paths


def folded(node, path):
    for slot, others in path:
        node = digest("".join([*others[:slot], node, *others[slot:]]))
    return node


def manifest(docs, changed, fanout=2):
    """{doc_id: (leaf, subroot, root, proof_sha256, folded_root)} of (doc_id, text, lang, source, n_chars) rows.

    `changed` tells of a doc_id whether n_chars is one more in what is folded.
    """
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in sorted(docs):
        other = n_chars + 1 if changed(doc_id) and n_chars is not None else n_chars
        groups[lang].append((doc_id, leaf([doc_id, source, lang, n_chars, text]), leaf([doc_id, source, lang, other, text])))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([row[1] for row in groups[x]], fanout) for x in langs}
    root, upper = tree([trees[x][0] for x in langs], fanout)
    found = {}
    for x, rest in zip(langs, upper):
        for (doc_id, own, other), path in zip(groups[x], trees[x][1]):
            path = path + rest
            siblings = digest("".join(s for _, others in path for s in others))
            found[doc_id] = (own, trees[x][0], root, siblings, folded(other, path))
    return found


def audit(docs, labels):
    """Rows of the filter audit, by playing every order over every document."""
    from itertools import permutations

    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for doc_id, text, lang in docs:
        w, t = words(text), text or ""
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and first[t] < doc_id,
        }
        parts[lang or ""].append((doc_id, {x for x in fails if fails[x]}))
    found = {}
    for part, held in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = held
            for step, x in enumerate(order, 1):
                gone = [d for d, fails in left if x in fails]
                left = [(d, fails) for d, fails in left if x not in fails]
                shapley[x] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in fails for _, fails in held) - len(gone), sum(fails == {x} for _, fails in held),
                    sum(d in good for d in gone), sum(d in toxic for d in gone),
                ]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return found
