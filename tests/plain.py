"""The generator's definition in plain Python, for expected values."""

from __future__ import annotations

import hashlib
import re

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def seed(value: str, scope: str, key: str = "test-key") -> str:
    return sha(f"{sha(f'{key}|{scope}')[:32]}|{value}")


def _mark(char: str) -> str:
    if char.isupper():
        return "A"
    if char.islower():
        return "a"
    return "0" if char.isdigit() else char


def _digits(number: int, base: int, count: int) -> list[int]:
    return [number // base**e % base for e in range(count - 1, -1, -1)]


def standard(value: str, scope: str = "project:p", key: str = "test-key") -> str:
    return replaced(value, seed(value, scope, key))


def replaced(value: str, first: str) -> str:
    """The text replaced by a given seed."""
    marks = "".join(_mark(c) for c in value)
    out = []
    for i, run in enumerate(re.findall(r"A?a{1,10}|A{1,11}|0{1,11}|[^Aa0]+", marks)):
        block = first if i < 4 else sha(f"{first}|{i // 4}")
        word = int(block[16 * (i % 4) :][:15], 16)
        if run[0] == "0":
            out += [str(d) for d in _digits(word, 10, len(run))]
        elif run[0] in "Aa":
            for mark, d in zip(run, _digits(word, 26, len(run))):
                out.append(LETTERS[d].upper() if mark == "A" else LETTERS[d])
        else:
            out.append(run)
    return "".join(out)
