"""Licence rules are tried wherever they can match."""

import re

from test_text_operators import collected, documents

from tidemark.llm import license_scan
from tidemark.llm.license_rules import rules

GATED = {
    "License: unauthorized copying of this file is strictly prohibited.": "proprietary",
    "licensed for personal use only": "non-commercial", "licensed for research use only": "non-commercial",
    "permission for academic purposes only": "non-commercial", "GNU Library General Public License version 2": "lgpl-2",
    "licensed under the PNG Reference Library version 2": "libpng-2", "licensed and distributed under the ISC terms": "isc",
}

UNOPENED = {
    "https://www.mozilla.org/MPL/2.0/": "mpl-2", "see creativecommons.org/publicdomain/zero/1.0": "cc0-1.0", "provided as is": "as-is",
    "for non-commercial use only": "non-commercial", "same terms as Perl itself": "perl", "released into the public\ndomain": "public-domain",
    "Creative\tCommons Attribution 4.0": "cc-by-4",
}


def ungated(text):
    """Labels by every rule at every place, without gates or prefilters, but for containment."""
    low = text.translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    line = f" {' '.join(re.findall(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', low))} "
    found = [(r, *m.span()) for r in rules() for m in re.finditer(r.pattern, line)]
    key = lambda x: (x[0].priority, line[x[1] : x[2]].count(" "), -x[0].number)
    kept = [d for d in found if not any(e[1] <= d[1] and e[2] >= d[2] and key(e) > key(d) for e in found)]
    return {d[0].label for d in kept}


def assert_as_ungated(spark, cases):
    got = collected(license_scan.scan_licenses(documents(spark, list(cases))))
    for i, (text, label) in enumerate(cases.items()):
        labels = set(filter(None, got[i]["labels"].split(",")))
        assert label in labels and labels - set(got[i]["base_labels"].split(",")) <= ungated(text) <= labels, text


def test_gates_let_every_alternative_through(spark):
    assert_as_ungated(spark, GATED)


def test_no_text_is_passed_over_before_the_rules(spark):
    # a mention of cc-by needs the word licen[cs]e, which the title form adds
    assert_as_ungated(spark, {t + (" license" if label == "cc-by-4" else ""): label for t, label in UNOPENED.items()})


def alternatives(nodes):
    """Texts of a parsed pattern: each optional part with and without, each branch, one digit."""
    out = {""}
    for op, arg in nodes:
        match str(op):
            case "LITERAL":
                more = {chr(arg)}
            case "MAX_REPEAT":
                more = ({""} if arg[0] == 0 else set()) | alternatives(arg[2])
            case "SUBPATTERN":
                more = alternatives(arg[3])
            case "BRANCH":
                more = set().union(*map(alternatives, arg[1]))
            case "IN":
                more = {chr(v) for kind, v in arg if str(kind) == "LITERAL"} or {"0"}
            case _:
                more = {""}
        out = {a + b for a in out for b in more}
    return out


def test_no_match_lacks_its_gate():
    for rule in rules():
        for text in alternatives(re._parser.parse(rule.pattern)):
            assert rule.gate in f" {text} ", (rule, text)
            assert any(w in text for w in license_scan.OPENING) or re.search(license_scan.CREATIVE, text), (rule, text)
