"""Plain Python versions of what the operators compute, for small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 2


def tiktoken_encoding():
    import tiktoken

    with open(tokens.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=tokens.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def bpe(docs):
    encoding = tiktoken_encoding()
    rows = []
    for doc_id, text in docs:
        ids = encoding.encode_ordinary(text or "")
        rows.append((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()),
                     sha((text or "").encode())))
    return rows


def sha(data):
    return hashlib.sha256(data).hexdigest()


def token_index(docs, end=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    rows, start = [], 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0,
                                                     r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def warc(pages, least=0):
    first = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    rows = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        again = page_id is not None and page_id > first[data] and len(data) >= least
        rows.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if again else "response", first[data] if again else None))
    return rows


def suffix(docs, least=50):
    low = -(1 << 63)
    first = {}
    for doc_id, text in docs:
        data, number = (text or "").encode(), low if doc_id is None else doc_id
        for i in range(len(data) - least + 1):
            s = data[i:i + least]
            first[s] = min(first.get(s, number), number)
    rows = []
    for doc_id, text in docs:
        data, number = (text or "").encode(), low if doc_id is None else doc_id
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - least + 1):
            if first[data[i:i + least]] < number:
                gone[i:i + least] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone[:len(data)]].tobytes()
        rows.append((doc_id, len(data), int(gone.sum()), spans, sha(kept)))
    return rows


def weighted_shingles(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return Counter([tuple(words)]) if words else None
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def weighted_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def classes(docs, least=0.8):
    """{doc_id: smallest doc_id of its class}; ids are unique and not null."""
    shingles = {doc_id: weighted_shingles(text) for doc_id, text in docs}
    where = defaultdict(list)
    for doc_id, counts in shingles.items():
        for key in counts or ():
            where[key].append(doc_id)
    parent = {doc_id: doc_id for doc_id, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in {(min(x, y), max(x, y)) for found in where.values()
                 for i, x in enumerate(found) for y in found[:i]}:
        if weighted_jaccard(shingles[a], shingles[b]) >= least:
            one, two = find(a), find(b)
            parent[max(one, two)] = min(one, two)
    return {doc_id: find(doc_id) for doc_id, _ in docs}


def leaks(docs, items, least=0.8):
    def shingles(text):
        words = WORD.findall((text or "").lower())
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}

    documents, wanted = defaultdict(set), defaultdict(set)
    for doc_id, text in docs:
        documents[doc_id] |= shingles(text)
    for item_id, text in items:
        wanted[item_id] |= shingles(text)
    return {(d, i, len(want & have), len(want)) for d, have in documents.items() if d is not None
            for i, want in wanted.items()
            if i is not None and want and len(want & have) >= least * len(want) - 1e-9}


def quality(docs):
    rows = []
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
                   for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        rows.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                     len(lines) - len(set(lines)), len(covered), failed))
    return rows


def fences(groups):
    """{group: fence} of {(lang, source): values}: upper quartile and six times the distance
    between the quartiles, at least ``floor``; own, language's and all texts' by their rows."""
    def fence(values, floor):
        low, high = (sorted(values)[max(0, -(-n * len(values) // 4) - 1)] for n in (1, 3))
        return high + max(6.0 * (high - low), floor)

    def between(values, floor, wider):
        weight = len(values) / (len(values) + 10)
        return weight * fence(values, floor) + (1 - weight) * wider

    def judge(floor):
        whole = fence([v for values in groups.values() for v in values], floor)
        found = {}
        for lang, source in groups:
            of_lang = [v for (other, _), values in groups.items() if other == lang for v in values]
            found[lang, source] = between(
                groups[lang, source], floor, between(of_lang, floor, whole))
        return found

    return judge


def verdicts(docs):
    """[(doc_id, kept)] of rows (doc_id, text, lang, source)."""
    floors = {"symbols": 0.03, "upper": 0.30, "repeat": 0.45, "lines": 0.50, "length": 3.0}
    rows = []
    counts = quality([d[:2] for d in docs])
    for (doc_id, text, lang, source), (_, n, chars, symbols, dup, repeated, failed) in zip(
            docs, counts, strict=True):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        upper = sum(len(w) > 1 and w == w.upper() != w.lower() for w in words)
        values = {"symbols": symbols / chars if chars else 0.0, "upper": upper / n if n else 0.0,
                  "repeat": repeated / n if n else 0.0,
                  "lines": dup / len(lines) if lines else 0.0, "length": chars / n if n else 0.0}
        rows.append((doc_id, (lang, source), values, failed))
    limits = {}
    for name, floor in floors.items():
        groups = defaultdict(list)
        for _, group, values, _ in rows:
            groups[group].append(values[name])
        limits[name] = fences(groups)(floor)
    return [(doc_id, not failed and all(values[m] <= limits[m][group] + 1e-12 for m in floors))
            for doc_id, group, values, failed in rows]


def base_scores(docs, folds=7):
    def split(text):
        return [*(text or "").encode().lower().split(), None]

    counts = Counter()
    for doc_id, text in docs:
        if not held(doc_id, folds):
            counts.update(split(text))
    n, v = sum(counts.values()), len(counts)
    return [(doc_id, held(doc_id, folds), len(split(text)),
             sum(counts[w] > 0 for w in split(text)), n,
             sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in split(text)))
            for doc_id, text in docs]


def chats(rows):
    """{conv_id: (turns, hex of turns, loss text)}; rows are (conv_id, turn, role, text)."""
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv_id, turns in groups.items():
        turns.sort()
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        found[conv_id] = (len(turns), sha(whole.encode()), loss)
    return found
