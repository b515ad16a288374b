"""Binary and nested payloads: swapped LZ4 blocks, and face groups in a document tree."""

from __future__ import annotations

LAST_LITERALS = 12


def _length(data, at: int, first: int) -> tuple[int, int]:
    """A length that starts with a nibble and goes on in bytes while they are full."""
    if first < 15:
        return first, at
    total = first
    while True:
        total += data[at]
        at += 1
        if data[at - 1] != 255:
            return total, at


def sequences(data, size: int, swapped: bool):
    """(token place, literal place, literal count, offset place or None, match length) of a block's sequences."""
    at = done = 0
    while True:
        token, place = data[at], at
        literal, match = (token & 15, token >> 4) if swapped else (token >> 4, token & 15)
        literal, at = _length(data, at + 1, literal)
        start, at, done = at, at + literal, done + literal
        if size - done < LAST_LITERALS:
            yield place, start, literal, None, 0
            return
        offset, at = at, at + 2
        match, at = _length(data, at, match)
        done += match + 4
        yield place, start, literal, offset, match + 4


def swap(block: bytes, size: int, swapped: bool = True) -> bytes:
    """A block with the nibbles of its tokens and the bytes of its offsets exchanged; swapped tells which way it is now."""
    out = bytearray(block)
    for place, _, _, offset, _ in list(sequences(block, size, swapped)):
        out[place] = (block[place] & 15) << 4 | block[place] >> 4
        if offset is not None:
            out[offset], out[offset + 1] = block[offset + 1], block[offset]
    return bytes(out)


def inflate(block: bytes, size: int, swapped: bool = True) -> bytes:
    """The content of a block of known size; ValueError if it is not one."""
    out = bytearray()
    try:
        for _, start, literal, offset, match in sequences(block, size, swapped):
            out += block[start : start + literal]
            if offset is None:
                break
            a, b = block[offset], block[offset + 1]
            back = a << 8 | b if swapped else b << 8 | a
            if not 0 < back <= len(out):
                raise ValueError("offset outside the block")
            for _ in range(match):
                out.append(out[-back])
    except IndexError:
        raise ValueError("block ends early") from None
    if len(out) != size:
        raise ValueError(f"{len(out)} bytes, {size} were promised")
    return bytes(out)


def face_groups(tree) -> list[dict]:
    """Pairs of facePos and faceSize anywhere in a document, in order of appearance; an unpaired rest is dropped."""
    seen: list[tuple[str, dict]] = []
    todo = [("", tree)]
    while todo:
        key, value = todo.pop()
        name = key[:1].lower() + key[1:]
        if isinstance(value, dict):
            if name in ("facePos", "faceSize") and "x" in value:
                seen.append((name, {c: int(value[c]) for c in ("x", "y")}))
            todo += reversed(list(value.items()))
        elif isinstance(value, list):
            todo += [(name, v) for v in reversed(value)]
    out, held = [], {}
    for name, value in seen:
        if len(held) == 2:
            out.append(held)
            held = {}
        held[name] = value
    return [*out, held] if len(held) == 2 else out
