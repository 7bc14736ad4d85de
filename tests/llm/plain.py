"""Brute-force versions of the operators, written without their methods."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def luhn(digits):
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def base_spans(text):
    """The four base kinds by their patterns, leftmost and non-overlapping."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def removed(docs, size=13):
    """Flags of the words that go, for (doc_id, text) rows."""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (doc, _), own in zip(docs, words):
        if doc is not None:
            for i in range(len(own) - size + 1):
                key = tuple(own[i : i + size])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), own in zip(docs, words):
        gone = [False] * len(own)
        if doc is not None:
            for i in range(len(own) - size + 1):
                if first[tuple(own[i : i + size])] < doc:
                    gone[i : i + size] = [True] * size
        out.append((own, gone))
    return out


def fingerprint(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=2):
    """The smallest reachable fingerprint of each, by all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {p: find(p) for p in prints}


def simhash_groups(docs, size=3, distance=2):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    own = [fingerprint(t, size) for _, t in docs]
    root = components(own, distance)
    least = {}
    for (doc, _), p in zip(docs, own):
        if doc is not None:
            least[root[p]] = min(least.get(root[p], doc), doc)
    return [(doc, p, least.get(root[p])) for (doc, _), p in zip(docs, own)]


def repetition(text, window=5, least=8):
    """Words, words in repeated windows, words in repeats of ``least``, longest repeat."""
    words = WORD.findall(text or "")

    def covered(size):
        places = defaultdict(list)
        for i in range(len(words) - size + 1):
            places[tuple(words[i : i + size])].append(i)
        return {
            j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + size)
        }

    longest = 0
    while len(words) > longest and max(
        Counter(
            tuple(words[i : i + longest + 1]) for i in range(len(words) - longest)
        ).values()
    ) > 1:
        longest += 1
    return (
        len(words),
        len(covered(window)),
        len(covered(least)),
        longest if longest >= min(window, least) else 0,
    )


def infix_distance(pattern, text):
    """Least edits between ``pattern`` and a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t))
    return min(row)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def squeezed(text):
    """Lower case with one space for white space, ASCII quotes and dashes."""
    text = re.sub(r"\s+", " ", text).strip(" ")
    text = re.sub("[\u2018\u2019\u201a\u201b\u2032]", "'", text)
    text = re.sub("[\u201c-\u201f\u2033\u00ab\u00bb]", '"', text)
    return re.sub("[\u2010-\u2015\u2212]", "-", text).lower()


def language_grams(text):
    """The three-letter n-grams of the words of a text, with a space on both sides."""
    spaced = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    return [f" {w} "[i : i + 3] for w in spaced.split() for i in range(len(w))]


def gram_hash(gram):
    value = 0
    for c in gram:
        value = (value ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
        value ^= value >> 29
    return value


def language_sets(labelled, rival=4, top_grams=4000, extra=10):
    """The n-grams of each language and in how many documents they are, by exact sets."""
    documents = Counter(lang for _, lang in labelled)
    counts = {lang: Counter() for lang in documents}
    for text, lang in labelled:
        counts[lang].update(set(language_grams(text)))
    largest = Counter()
    for lang, own in counts.items():
        for gram, n in own.items():
            largest[gram] = max(largest[gram], n / (documents[lang] + extra))
    sets = {
        lang: {g for g, n in own.items() if n / (documents[lang] + extra) * rival >= largest[g]}
        for lang, own in counts.items()
    }
    assert all(len(own) <= top_grams for own in sets.values())
    return sets, {lang: {g: counts[lang][g] for g in own} for lang, own in sets.items()}


def language_shares(text, sets):
    """The part of a text's n-grams that each language has; None without a letter."""
    grams = language_grams(text)
    return {lang: sum(g in own for g in grams) / len(grams) for lang, own in sets.items()} if grams else None
