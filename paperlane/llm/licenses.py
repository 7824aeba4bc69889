"""License scan: identifier tags, notice phrases and licence expressions.

An Aho-Corasick automaton over the words of a text (lower case, one space
between two) finds the notice phrases; another over the lower-cased text finds
identifier tags. The expression after a tag is tokenised, brought to postfix
order by a shunting yard (``with`` binds tighter than ``and``, ``and`` than
``or``) and evaluated to its alternatives: sets of licences that hold
together; one with over 64 alternatives is given as it is written. Its licences
are its labels, at any size. A broken expression (missing operand, unbalanced parenthesis) gives
the label ``invalid-expression`` instead of licences; a single word that is no
SPDX identifier gives ``unknown-identifier`` (in an expression of several it is
given as it is written).

Everything is local to one document: no shuffle, memory follows the longest
single text.

Defined cases: a null text is empty; a text without a hit has null
``first_word`` and ``last_word``, empty labels and score 0; repeated rows give
repeated results; null ids stay null; an empty table gives an empty result;
invalid UTF-8 is read as U+FFFD; extra columns of the input are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from .common import ALNUM_LOWER, id_and_text, id_type, map_rows

#: The phrases of the query contract (words) and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases (words) and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person": "mit-text",
    "redistribution and use in source and binary forms": "bsd-text",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "boost software license": "bsl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "all rights reserved": "all-rights-reserved",
    "the software is provided as is without warranty of any kind": "as-is-text",
    "permission to use copy modify and or distribute this software for any purpose": "isc-text",
    "this program is free software you can redistribute it and or modify": "gpl-text",
    "this is free and unencumbered software released into the public domain": "unlicense-text",
    "you may not use this file except in compliance with the license": "apache-text",
    "subject to the terms of the mozilla public license": "mpl-text",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-text",
    "this software is provided by the copyright holders and contributors as is": "bsd-text",
    "do what the fuck you want to public license": "wtfpl",
    "no rights reserved": "public-domain",
}
#: Public SPDX identifiers of licences and of exceptions, in lower case.
IDENTIFIERS = frozenset("""
0bsd afl-2.1 afl-3.0 agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0
artistic-1.0 artistic-1.0-perl artistic-2.0 beerware bitstream-vera blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause
bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0
cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 curl ecl-2.0 efl-2.0
epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.2-only gfdl-1.2-or-later gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0 gpl-1.0-only
gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg imagemagick intel ipl-1.0 isc
jasper-2.0 json lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later
libpng libpng-2.0 libtiff lppl-1.3c mit mit-0 mit-cmu mit-modern-variant mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa nist-pd
ofl-1.0 ofl-1.1 oldap-2.8 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sspl-1.0 tcl unicode-3.0
unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib zlib-acknowledgement zpl-2.1
autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-3.1 libtool-exception
linux-syscall-note llvm-exception openssl-exception ocaml-lgpl-linking-exception qt-gpl-exception-1.0 swift-exception
universal-foss-exception-1.0 u-boot-exception-2.0 wxwindows-exception-3.1
""".split())
TAGS = ("spdx-license-identifier:", "license-expression:")
#: How sure one hit of a kind makes us that the text carries a licence notice.
WEIGHTS = {"tag": 0.95, "base": 0.8, "notice": 0.6, "unknown": 0.3}
_RANK = {"or": 1, "and": 2, "with": 3}


def known(name: str) -> bool:
    """Whether a lower-case name is an SPDX identifier (``+``: or later) or a
    reference to a licence of one's own."""
    return name.removesuffix("+") in IDENTIFIERS or name.startswith(("licenseref-", "documentref-"))


def expression_tokens(text: str, at: int = 0, stop: int | None = None) -> list[str]:
    """Lower-case tokens of the expression that begins at a place of ``text``:
    identifiers, operators and parentheses up to the first thing that is neither
    (a line end, a comment end, a word that follows an operand)."""
    import re

    tokens, depth = [], 0
    part = re.compile(r"[ \t]*(?:([()])|([a-z0-9][a-z0-9.+:-]*))")
    stop = len(text) if stop is None else stop
    while m := part.match(text, at, stop):
        t = m[1] or m[2].rstrip(".:-")
        operand = bool(tokens) and (tokens[-1] == ")" or tokens[-1] not in (*_RANK, "("))
        if operand and t not in _RANK and t != ")":
            break
        if t == ")" and not depth:
            break
        depth += (t == "(") - (t == ")")
        tokens.append(t)
        at = m.end()
    return tokens


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting yard; None when the tokens are no expression."""
    out, stack, operand_next = [], [], True
    for t in tokens:
        if t == "(":
            if not operand_next:
                return None
            stack.append(t)
        elif t == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in _RANK:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(t)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def alternatives(tokens: list[str], most: int = 64) -> list[frozenset[str]] | None:
    """The sets of licences, each of which satisfies the expression (``a with
    e`` is one licence). None when it is broken or has over ``most``
    alternatives; :func:`licences` tells the two apart."""
    rpn = postfix(tokens)
    if rpn is None:
        return None
    stack: list[list[frozenset[str]]] = []
    for t in rpn:
        if t not in _RANK:
            stack.append([frozenset([t])])
            continue
        b, a = stack.pop(), stack.pop()
        if t == "or":
            made = a + [x for x in b if x not in a]
        elif t == "and":
            made = list(dict.fromkeys(x | y for x in a for y in b))
        else:
            if len(a) != 1 or len(b) != 1 or len(a[0]) != 1 or len(b[0]) != 1:
                return None
            made = [frozenset([f"{next(iter(a[0]))} with {next(iter(b[0]))}"])]
        if len(made) > most:
            return None
        stack.append(made)
    return stack[0]


def licences(tokens: list[str]) -> set[str] | None:
    """All licences of an expression of any size; None when it is broken."""
    rpn = postfix(tokens)
    if rpn is None:
        return None
    stack: list[set[str]] = []
    for t in rpn:
        if t not in _RANK:
            stack.append({t})
            continue
        b, a = stack.pop(), stack.pop()
        if t != "with":
            small, large = sorted((a, b), key=len)
            large |= small
            stack.append(large)
        elif len(a) == len(b) == 1:
            stack.append({f"{a.pop()} with {b.pop()}"})
        else:
            return None
    return stack[0]


def as_written(tokens: list[str]) -> str:
    return " ".join(tokens).replace("( ", "(").replace(" )", ")")


def scan_text(text: bytes, phrases, tags):
    """The result columns of one text; ``phrases`` and ``tags`` are automata."""
    joined = b" " + b" ".join(text.translate(ALNUM_LOWER).split()) + b" "
    n_words = joined.count(b" ") - 1 if len(joined) > 2 else 0
    joined = joined.decode(errors="replace")
    n_base, first, last, labels, base, doubt = 0, None, None, set(), set(), 1.0
    for end, (size, kind, label) in phrases.iter(joined):
        labels.add(label)
        if kind == "base":
            at = end - size + 1
            n_base += 1
            base.add(label)
            first = at if first is None else min(first, at)
            last = at if last is None else max(last, at)
        doubt = min(doubt, 1 - WEIGHTS[kind])
    first, last = (None if at is None else joined.count(" ", 0, at + 1) - 1 for at in (first, last))
    expressions = []
    lowered = text.lower().decode(errors="replace")
    for end, _ in tags.iter(lowered):
        tokens = expression_tokens(lowered, end + 1)  # it ends with the line
        if not tokens:
            continue
        if len(tokens) == 1 and not known(tokens[0]):  # a word of prose after the tag, or a misspelt name
            labels.add("unknown-identifier")
            doubt = min(doubt, 1 - WEIGHTS["unknown"])
            continue
        names = licences(tokens)
        if names is None:
            labels.add("invalid-expression")
            expressions.append("invalid")
        else:
            labels |= {f"spdx:{x}" for x in names}
            sets = alternatives(tokens)
            expressions.append(as_written(tokens) if sets is None else
                               " or ".join(" and ".join(sorted(s)) for s in sets))
        doubt = min(doubt, 1 - WEIGHTS["tag"])
    score = 0.0 if not labels else min(1.0, 1 - doubt + 0.01 * (min(len(labels), 5) - 1))
    return (n_words, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 6),
            expressions)


def automata():
    import ahocorasick

    phrases = ahocorasick.Automaton()
    for kind, group in (("notice", NOTICE_PHRASES), ("base", BASE_PHRASES)):
        for phrase, label in group.items():
            phrases.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    phrases.make_automaton()
    tags = ahocorasick.Automaton()
    for t in TAGS:
        tags.add_word(t, t)
    tags.make_automaton()
    return phrases, tags


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: word count, places and labels of the base phrases,
    all labels, ``score`` (how sure a licence notice is present) and
    ``expressions`` (each tag's expression as its alternatives)."""
    fields = [("doc_id", id_type(docs, id_col)), ("n_words", "long"),
              ("n_base", "long"), ("first_word", "long"), ("last_word", "long"), ("base_labels", "string"),
              ("labels", "string"), ("score", "double"), ("expressions", "array<string>")]

    def make():
        phrases, tags = automata()
        return lambda text: scan_text(text, phrases, tags)

    return map_rows(id_and_text(docs, id_col, text_col), make, fields)
