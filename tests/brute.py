"""Plain Python versions of the rules, for small inputs."""

from __future__ import annotations

import re

BLANKS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def rate(ref, hyp):
    if not len(ref):
        return 1.0 if len(hyp) else 0.0
    return distance(ref, hyp) / len(ref)


def is_noise(s):
    return s != "" and not s.strip(BLANKS + "._-")


def is_index_like(s):
    return len(s) > 10 and 2 * sum(ch in "._" for ch in s) > len(s)


def targets(seed):
    state = seed
    while True:
        state = (state * 1103515245 + 12345) % 2**31
        yield 200 + state % 401


def word_blocks(sentence):
    blocks, current = [], None
    for word in sentence.split():
        longer = word if current is None else f"{current} {word}"
        if len(longer) > 600:
            blocks.append(current or "")
            longer = word
        current = longer
    return blocks + [current]


def paragraph_blocks(paragraph):
    blocks, waiting, size = [], [], 0
    pieces = [s.strip() for s in re.split(r"(?<=[.!?])\s+", paragraph)]
    for s in [s for s in pieces if s and not is_noise(s)]:
        if len(s) > 600:
            blocks += word_blocks(s)
        elif size + len(s) + 1 > 600:
            blocks += ["\n".join(waiting)] * bool(waiting)
            waiting, size = [s], len(s)
        else:
            waiting.append(s)
            size += len(s) + 1
    return blocks + ["\n".join(waiting)] * bool(waiting)


def blocks(text, seed):
    if len(text) < 200:
        return []
    draw = targets(seed)
    target, waiting, size, out = next(draw), [], 0, []
    paragraphs = [p.strip() for p in re.split("[\r\n]+", text)]
    for p in paragraphs:
        if not p or is_noise(p) or is_index_like(p):
            continue
        flush = "\n\n".join(waiting)
        if len(p) > 600:
            if waiting:
                out.append(flush)
                waiting, size, target = [], 0, next(draw)
            out += paragraph_blocks(p)
        elif size + len(p) + 2 > 600:
            out += [flush] * bool(waiting)
            waiting, size, target = [p], len(p), next(draw)
        else:
            waiting.append(p)
            size += len(p) + 2
            if size >= target:
                out.append("\n\n".join(waiting))
                waiting, size, target = [], 0, next(draw)
    return out + ["\n\n".join(waiting)] * bool(waiting)
