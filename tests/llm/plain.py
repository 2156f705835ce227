"""Plain versions of operators on Python dictionaries, doc_id to text."""

from llm.test_llm_near import parts_of, shingles
from llm.test_llm_tables import plain_leaks

from eventlake.llm.paragraphs import LINES

__all__ = ["least_of_components", "paragraphs_left", "plain_leaks"]


def least_of_components(docs):
    """The ids that stay: the least of each component, and every text without words."""
    ids = sorted(docs)
    sets = [shingles(docs[d]) for d in ids]
    seen, out = set(), set()
    for d, s, p in zip(ids, sets, parts_of(sets), strict=True):
        if not s or p not in seen:
            out.add(d)
        seen.add(p)
    return out


def paragraphs_left(docs):
    """Each text without the lines whose component comes earlier."""
    lines = [(d, no, line) for d in sorted(docs) for no, line in enumerate(docs[d].split("\n"))]
    sets = [shingles(line, LINES.least_words) for *_, line in lines]
    seen, out = set(), {d: [] for d in docs}
    for (d, _, line), s, p in zip(lines, sets, parts_of(sets), strict=True):
        if s and p in seen:
            continue
        if s:
            seen.add(p)
        out[d].append(line)
    return {d: "\n".join(left) for d, left in out.items()}
