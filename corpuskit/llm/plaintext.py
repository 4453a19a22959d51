"""Text reduced to what readers see, for matching passages."""

from __future__ import annotations

#: Letters that look like Latin ones. Fixed values.
_PAIRS = (
    "а a б b в b г r е e з 3 и n к k м m н h о o р p с c т t у y х x і i ј j ѕ s ԁ d һ h ԛ q ԝ w ү y "
    "ь b ɑ a ɡ g ı i ł l ø o đ d œ oe æ ae α a β b γ y ε e ι i η n κ k ν v ο o ρ p τ t υ u χ x ω w σ o"
).split()
LOOKALIKES = dict(zip(_PAIRS[::2], _PAIRS[1::2]))


#: ASCII characters that are neither letters nor digits.
_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())


def letters(text: str) -> str:
    """Letters and digits only, without case, accents, lookalikes, tags and link targets.
    Entities are read as their characters; numbers of list items are words like any other."""
    import html
    import re
    import unicodedata

    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = re.sub(r"<[/!]?[a-zA-Z][^<>]*>", "", text)
    if "](" in text:
        text = re.sub(r"\]\([^()\s]*\)", " ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).casefold()
        rare = {c for c in set(text) if c > "\x7f"}
        alike = rare & LOOKALIKES.keys()
        if alike:
            text = text.translate({ord(c): LOOKALIKES[c] for c in alike})
        if any(c.isalnum() for c in rare - alike):  # other scripts
            return re.sub(r"[\W_]+", "", text).casefold()
    return text.encode("ascii", "ignore").translate(None, _MARKS).lower().decode("ascii")


def numbered_letters(text: str) -> tuple[str, list[tuple[int, int]]] | None:
    """Letters without the numbers of list items that rise one by one, and where each such
    item starts and ends in them (the last of a list with its line); None if there are none."""
    import re

    found = list(re.finditer(r"(?m)^[ \t>*-]*(\d{1,3})[.)][ \t]+", text))
    values = [int(m[1]) for m in found]
    rising = [k > 0 and values[k - 1] + 1 == v for k, v in enumerate(values)]
    starts = [m for k, m in enumerate(found) if rising[k] or rising[k + 1 : k + 2] == [True]]
    if not starts:
        return None
    after = {m.start(): n for m, n, r in zip(found, found[1:], rising[1:]) if r}
    cuts = set()
    for m in starts:
        n, line = after.get(m.start()), text.find("\n", m.end())
        cuts.add((m.start(), m.end(), n.start() if n else line if line >= 0 else len(text)))
    parts, size, at, entries = [], 0, 0, []
    for start, end, stop in sorted(cuts):
        for piece in (text[at:start], text[end:stop]):
            parts.append(letters(piece))
            size += len(parts[-1])
        entries.append((size - len(parts[-1]), size))
        at = stop
    return "".join(parts) + letters(text[at:]), entries
