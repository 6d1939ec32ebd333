"""Plain versions of the operators, for small tables."""

from hashlib import sha256


def substring_rows(docs, width):
    """(doc_id, n_bytes, n_removed, n_spans, sha) by looking at every string."""
    least = {}
    bodies = {doc_id: (text or "").encode() for doc_id, text in docs if doc_id is not None}
    for doc_id, body in bodies.items():
        for p in range(len(body) - width + 1):
            part = body[p : p + width]
            least[part] = min(least.get(part, doc_id), doc_id)
    rows = []
    for doc_id, text in docs:
        body = (text or "").encode()
        gone = bytearray(len(body))
        if doc_id is not None:
            for p in range(len(body) - width + 1):
                if least[body[p : p + width]] < doc_id:
                    gone[p : p + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        rows.append((doc_id, len(body), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def window_rows(docs, width):
    """(doc_id, n_words, n_removed, sha) by looking at every window."""
    first = {}
    bodies = {doc_id: (text or "").encode().split() for doc_id, text in docs if doc_id is not None}
    for doc_id in sorted(bodies):
        words = bodies[doc_id]
        for p in range(len(words) - width + 1):
            first.setdefault(tuple(words[p : p + width]), (doc_id, p))
    rows = []
    for doc_id, text in docs:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        if doc_id is not None:
            for p in range(len(words) - width + 1):
                if first[tuple(words[p : p + width])] < (doc_id, p):
                    gone[p : p + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        rows.append((doc_id, len(words), sum(gone), sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def plain_tiles(item, text, match):
    """Greedy string tiling by looking at every pair of places in every round."""
    free_item, free_text = [True] * len(item), [value > 0 for value in text]
    found, size = [], max(match, min(len(item), 20))
    while True:
        pairs = []
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while (
                    p + k < len(item) and t + k < len(text)
                    and free_item[p + k] and free_text[t + k] and item[p + k] == text[t + k]
                ):
                    k += 1
                if k >= size:
                    pairs.append((-k, p, t))
        longest = -min(pairs)[0] if pairs else 0
        if longest > 2 * size:
            size = longest
            continue
        marked = False
        for k, p, t in sorted(pairs):
            if all(free_item[p : p - k]) and all(free_text[t : t - k]):
                free_item[p : p - k] = [False] * -k
                free_text[t : t - k] = [False] * -k
                found.append((p, t, -k))
                marked = True
        if not marked:
            if size == match:
                return found
            size = max(match, size // 2)


def plain_leaks(docs, items, match, coverage, words_of):
    """(doc_id, item_id, n_tokens, n_covered, n_tiles) by tiling every text with every item."""
    rows = set()
    for item_id, item in set(items):
        words = words_of(item)
        numbers = {word: number for number, word in enumerate(dict.fromkeys(words), 1)}
        for doc_id, text in set(docs):
            other = [numbers.get(word, 0) for word in words_of(text)]
            if words and any(other):
                found = plain_tiles([numbers[word] for word in words], other, min(match, len(words)))
                n = sum(k for _, _, k in found)
                if n >= coverage * len(words):
                    rows.add((doc_id, item_id, len(words), n, len(found)))
    return rows
