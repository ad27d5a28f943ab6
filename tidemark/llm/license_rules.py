"""Signature rules for licence statements over lower-cased words joined by single spaces.

Every licence family lists its names as they are written, and gets a rule per form of statement: identifier, grant, address, title and
mention. Rules are tried in no order; priority and containment decide between overlapping detections.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Label | words that open the gate (_ for a blank at an edge) and stand in every match | name as a regular expression | words of its address, if any
FAMILIES = """
mit | _mit_ | (?:the )?mit(?: x11)? | opensource org licenses? mit
mit-0 | _mit_ | mit (?:0|no attribution) | opensource org licenses? mit 0
apache-1.0 | apache | apache(?: software)?(?: license)?(?: version)? 1 0 | apache org licenses license 1 0
apache-1.1 | apache | apache(?: software)?(?: license)?(?: version)? 1 1 | apache org licenses license 1 1
apache-2 | apache | apache(?: software)?(?: license)?(?: version| v)? 2(?: 0)? | apache org licenses license 2 0
bsd-2-clause | bsd | (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) | opensource org licenses? bsd 2 clause
bsd-3-clause | bsd | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) | opensource org licenses? bsd 3 clause
bsd-4-clause | bsd | (?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd) | directory fsf org wiki license bsd 4clause
0bsd | bsd | (?:0bsd|zero clause bsd|bsd 0 clause) | opensource org licenses? 0bsd
isc | _isc_ | (?:the )?isc | opensource org licenses? isc
gpl-1 | general public | gnu general public license(?: version| v)? 1(?: 0)? | gnu org licenses (?:old licenses )?gpl 1 0
gpl-2 | general public | gnu general public license(?: version| v)? 2(?: 0)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3 | general public | gnu general public license(?: version| v)? 3(?: 0)? | gnu org licenses gpl 3 0
gpl | general public | gnu general public license | gnu org licenses gpl
gpl-2-short | gpl | (?:gnu )?gpl(?: version| v)? ?2(?: 0)? | gnu org copyleft gpl 2
gpl-3-short | gpl | (?:gnu )?gpl(?: version| v)? ?3(?: 0)? | gnu org copyleft gpl 3
lgpl-2 | general public | gnu (?:library|lesser) general public license(?: version| v)? 2(?: 0)? | gnu org licenses (?:old licenses )?lgpl 2 0
lgpl-2.1 | lesser | gnu lesser general public license(?: version| v)? 2 1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 | lesser | gnu lesser general public license(?: version| v)? 3(?: 0)? | gnu org licenses lgpl 3 0
lgpl | lesser | gnu lesser general public license | gnu org licenses lgpl
agpl-1 | affero | affero general public license(?: version| v)? 1(?: 0)? | affero org oagpl
agpl-3 | affero | (?:gnu )?affero general public license(?: version| v)? 3(?: 0)? | gnu org licenses agpl 3 0
agpl | affero | (?:gnu )?affero general public license | gnu org licenses agpl
gfdl-1.1 | free documentation | gnu free documentation license(?: version| v)? 1 1 | gnu org licenses (?:old licenses )?fdl 1 1
gfdl-1.2 | free documentation | gnu free documentation license(?: version| v)? 1 2 | gnu org licenses (?:old licenses )?fdl 1 2
gfdl-1.3 | free documentation | gnu free documentation license(?: version| v)? 1 3 | gnu org licenses fdl 1 3
gfdl | free documentation | gnu free documentation license | gnu org licenses fdl
mpl-1.0 | mozilla | mozilla public license(?: version| v)? 1 0 | mozilla org mpl mpl 1 0
mpl-1.1 | mozilla | mozilla public license(?: version| v)? 1 1 | mozilla org mpl 1 1
mpl-2 | mozilla | mozilla public license(?: version| v)? 2(?: 0)? | mozilla org (?:en us )?mpl 2 0
epl-1 | eclipse | eclipse public license(?: version| v)? 1(?: 0)? | eclipse org legal epl v10
epl-2 | eclipse | eclipse public license(?: version| v)? 2(?: 0)? | eclipse org legal epl (?:2 0|v20)
edl-1 | eclipse | eclipse distribution license(?: version| v)? 1(?: 0)? | eclipse org org documents edl v10
eupl-1.1 | european union | european union public licen[cs]e(?: version| v)? 1 1 | joinup ec europa eu software page eupl
eupl-1.2 | european union | european union public licen[cs]e(?: version| v)? 1 2 | eupl eu 1 2
cddl-1.0 | common development | common development and distribution license(?: version| v)? 1 0 | opensource org licenses? cddl 1 0
cddl-1.1 | common development | common development and distribution license(?: version| v)? 1 1 | glassfish java net public cddl
cpl-1 | common public | common public license(?: version| v)? 1(?: 0)? | opensource org licenses? cpl 1 0
cpal-1 | common public attribution | common public attribution license(?: version| v)? 1(?: 0)? | opensource org licenses? cpal 1 0
artistic-1 | artistic | artistic license(?: version| v)? 1(?: 0)? | opensource org licenses? artistic license 1 0
artistic-2 | artistic | artistic license(?: version| v)? 2(?: 0)? | opensource org licenses? artistic license 2 0
boost-1 | boost | boost software license(?: version| v)? 1(?: 0)? | boost org license 1 0
zlib | zlib | (?:the )?zlib(?: libpng)? | opensource org licenses? zlib
libpng-2 | png | (?:png reference library|libpng)(?: version| v)? 2(?: 0)? | libpng org pub png src libpng license
unlicense | unlicense | (?:the )?unlicense | unlicense org
wtfpl | public license | do what the f\\w+ you want to public license | wtfpl net
beerware | beerware | (?:the )?beerware | people freebsd org phk
cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)? | creativecommons org publicdomain zero 1 0
cc-by-1 | cc by | (?:cc by|creative commons attribution) 1 0 | creativecommons org licenses by 1 0
cc-by-2 | cc by | (?:cc by|creative commons attribution) 2 0 | creativecommons org licenses by 2 0
cc-by-2.5 | cc by | (?:cc by|creative commons attribution) 2 5 | creativecommons org licenses by 2 5
cc-by-3 | cc by | (?:cc by|creative commons attribution) 3 0 | creativecommons org licenses by 3 0
cc-by-4 | cc by | (?:cc by|creative commons attribution) 4 0 | creativecommons org licenses by 4 0
cc-by-sa-3 | cc by sa | (?:cc by sa|creative commons attribution share ?alike) 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-4 | cc by sa | (?:cc by sa|creative commons attribution share ?alike) 4 0 | creativecommons org licenses by sa 4 0
cc-by-nc-2 | cc by nc | (?:cc by nc|creative commons attribution non ?commercial) 2 0 | creativecommons org licenses by nc 2 0
cc-by-nc-3 | cc by nc | (?:cc by nc|creative commons attribution non ?commercial) 3 0 | creativecommons org licenses by nc 3 0
cc-by-nc-4 | cc by nc | (?:cc by nc|creative commons attribution non ?commercial) 4 0 | creativecommons org licenses by nc 4 0
cc-by-nd-3 | cc by nd | (?:cc by nd|creative commons attribution no ?derivatives) 3 0 | creativecommons org licenses by nd 3 0
cc-by-nd-4 | cc by nd | (?:cc by nd|creative commons attribution no ?derivatives) 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-3 | cc by nc sa | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 3 0 | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4 | cc by nc sa | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3 | cc by nc nd | (?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives) 3 0 | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4 | cc by nc nd | (?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives) 4 0 | creativecommons org licenses by nc nd 4 0
odbl-1 | database | open (?:data commons )?(?:open )?database license(?: version| v)?(?: 1 0)? | opendatacommons org licenses odbl
odc-by-1 | data commons | open data commons attribution license(?: version| v)?(?: 1 0)? | opendatacommons org licenses by
pddl-1 | public domain dedication | (?:open data commons )?public domain dedication and license(?: 1 0)? | opendatacommons org licenses pddl
ofl-1.1 | open font | (?:sil )?open font license(?: version| v)?(?: 1 1)? | scripts sil org ofl
python-2 | python | python(?: software foundation)? license(?: version| v)?(?: 2)? | docs python org license
php-3 | php | php license(?: version| v)? 3(?: 0(?:1)?)? | php net license
ruby | ruby | ruby license | ruby lang org en about license
perl | perl | same terms as perl(?: itself)? | dev perl org licenses
postgresql | postgresql | postgresql licen[cs]e | postgresql org about licen[cs]e
openssl | openssl | (?:dual )?openssl(?: and ssleay)? license | openssl org source license
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? license | opensource org licenses? ncsa
curl | curl | (?:the )?curl license | curl se docs copyright
tcl | tcl | tcl tk license | tcl tk software license
w3c | w3c | w3c software(?: notice and)? license | w3 org consortium legal copyright software
osl-3 | open software | open software license(?: version| v)? 3(?: 0)? | opensource org licenses? osl 3 0
afl-3 | academic free | academic free license(?: version| v)? 3(?: 0)? | opensource org licenses? afl 3 0
ms-pl | microsoft | microsoft public license | opensource org licenses? ms pl
ms-rl | microsoft | microsoft reciprocal license | opensource org licenses? ms rl
upl-1 | universal permissive | universal permissive license(?: version| v)?(?: 1 0)? | opensource org licenses? upl
bsl-1.1 | business source | business source license(?: version| v)?(?: 1 1)? | mariadb com bsl11
sspl-1 | server side | server side public license(?: version| v)?(?: 1)? | mongodb com licensing server side public license
elastic-2 | elastic | elastic license(?: version| v)?(?: 2 0)? | elastic co licensing elastic license
polyform | polyform | polyform (?:noncommercial|perimeter|shield|strict|small business|internal use) license | polyformproject org licenses
openrail | openrail | (?:bigscience |creativeml )?openrail(?: m)? | bigscience huggingface co license
llama-2 | llama | llama 2 community license | ai meta com llama license
"""

# Label | words that open the gate | regular expression | priority | relevance in hundredths
STATEMENTS = """
all-rights-reserved | rights reserved | all rights reserved | 40 | 60
some-rights-reserved | rights reserved | some rights reserved | 40 | 50
no-rights-reserved | rights reserved | no rights reserved | 45 | 60
public-domain | public domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain | 60 | 90
public-domain | public domain | in the public domain | 30 | 60
proprietary | proprietary | proprietary and confidential | 50 | 80
proprietary | prohibited | (?:unauthori[sz]ed )?(?:copying|reproduction|distribution)(?: of this (?:file|work))? is (?:strictly )?prohibited | 50 | 80
warranty-disclaimer | warranty | without warranty of any kind | 20 | 40
warranty-disclaimer | warranties | without warranties or conditions of any kind | 20 | 40
as-is | as is | (?:provided|distributed) (?:on an )?as is(?: basis)? | 20 | 40
permissive-text | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy | 55 | 85
permissive-text | permission to use | permission to use copy modify and or? ?distribute this software | 55 | 80
redistribution-text | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted | 55 | 85
copyleft-text | free software | this program is free software you can redistribute it and or modify it | 55 | 80
non-commercial | use only | for (?:non ?commercial|personal|academic|research)(?: and (?:non ?commercial|academic|research))? use only | 35 | 60
non-commercial | purposes only | for (?:non ?commercial|personal|academic|research)(?: and (?:non ?commercial|academic|research))? purposes only | 35 | 60
copyright-notice | copyright | copyright (?:c )?(?:19|20)\\d\\d | 25 | 40
source-available | source available | source available license | 35 | 50
dual-licence | licensed | dual licensed | 35 | 50
"""

# Forms of a statement about a licence; priority and relevance in hundredths
GRANT = (
    r"(?:dual |multi )?(?:licensed|released|distributed|published|available|provided|covered|governed)"
    r"(?: to you)?(?: under| by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {name}(?: licen[cs]e)?"
)
FORMS = (
    ("identifier", "spdx license identifier {label}", 100, 100),
    ("grant", GRANT, 90, 95),
    ("address", "(?:https? )?(?:www )?{address}", 80, 90),
    ("title", "{name} licen[cs]e", 70, 80),
    ("mention", "{full}", 60, 70),
)


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    gate: str  # words that must stand in the text for the rule to be tried
    pattern: str
    priority: int
    relevance: float


def rules() -> list[Rule]:
    out: list[Rule] = []

    def add(label: str, gate: str, pattern: str, priority: int, hundredths: int) -> None:
        out.append(Rule(len(out), label, gate, rf"(?<= )(?:{pattern})(?= )", priority, hundredths / 100))

    for line in FAMILIES.strip().splitlines():
        label, gate, name, address = (part.strip().replace("\\\\", "\\") for part in line.split(" | "))
        gate = gate.replace("_", " ")
        spdx = " ".join(label.replace(".", " ").replace("-", " ").split())
        wordy = "licen" in name or len(name.split()) > 3  # a name that says by itself that it is a licence
        names = [(gate, name)]
        if gate.startswith("cc by"):  # the short and the long name have a gate of their own
            short, long = re.fullmatch(r"\(\?:(.*?)\|(.*)\) \d \d", name).groups()
            names = [("cc by", f"{short} {name[-3:]}"), ("creative commons", f"{long} {name[-3:]}")]
        for form, pattern, priority, hundredths in FORMS:
            if form == "mention" and not wordy:
                continue
            for opens, one in names if "{name}" in pattern or "{full}" in pattern else names[:1]:
                word = {"identifier": "spdx", "address": " ".join(address.split(" ")[:2])}.get(form, opens)
                add(
                    label.removesuffix("-short"), word, pattern.format(name=one, label=spdx, address=address, full=one),
                    priority, hundredths,
                )
    for line in STATEMENTS.strip().splitlines():
        label, gate, pattern, priority, hundredths = (part.strip().replace("\\\\", "\\") for part in line.split(" | "))
        add(label, gate, pattern, int(priority), int(hundredths))
    return out
