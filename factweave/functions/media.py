"""Media types: which variant of a document a client gets."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Range:
    """A media type or range with its parameters and quality."""

    kind: str
    sub: str
    parameters: frozenset
    quality: float

    def fits(self, other: "Range") -> int:
        """How closely ``other`` (a type) lies in this range: 0 not, 1 any type, 2 any subtype, 3 the type, more with its parameters."""
        if self.kind == "*":
            return 1
        if self.kind != other.kind:
            return 0
        if self.sub == "*":
            return 2
        if self.sub != other.sub or not self.parameters <= other.parameters:
            return 0
        return 3 + len(self.parameters)


def parse_range(text: str) -> Range | None:
    """``type/subtype; name=value; q=0.8``; null if it is none."""
    head, *rest = (x.strip() for x in text.split(";"))
    kind, slash, sub = head.lower().partition("/")
    if not slash or not kind or not sub or (kind == "*" and sub != "*"):
        return None
    quality, parameters = 1.0, set()
    for p in rest:
        name, _, value = (x.strip() for x in p.partition("="))
        if name.lower() == "q":
            try:
                quality = min(1.0, max(0.0, float(value)))
            except ValueError:
                return None
        else:
            parameters.add((name.lower(), value.strip('"')))
    return Range(kind, sub, frozenset(parameters), quality)


def best_variant(accept: str, variants: list[str]) -> str | None:
    """The variant (types with the server's quality) of the best product of qualities; the closest range of the client counts for each.

    Equal products go to the variant that is listed first; without a header the server's quality decides; null if none is acceptable.
    """
    wanted = [r for r in map(parse_range, accept.split(",")) if r] if accept.strip() else [parse_range("*/*")]
    best, found = 0.0, None
    for text in variants:
        v = parse_range(text)
        fit = max(((r.fits(v), r.quality) for r in wanted), default=(0, 0.0))
        score = fit[1] * v.quality if fit[0] else 0.0
        if score > best:
            best, found = score, f"{v.kind}/{v.sub}"
    return found
