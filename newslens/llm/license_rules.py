"""Signature rules of licences, written by hand, over words in lower case with single blanks between them.

Names are used in four kinds of wording; signatures are sentences of licence texts and notices. ``\\s`` does not occur: a blank is
a blank. Gaps are bounded, so no pattern can run away.
"""

from __future__ import annotations

from dataclasses import dataclass

# Label | beginning of a word that every match holds | name as pattern over normalised words.
NAMES = """
0bsd | 0bsd | 0bsd(?: license)?
0bsd | bsd | (?:bsd zero clause|zero clause bsd)(?: license)?
afl-3.0 | academic | academic free license(?: version| v)?(?: 3(?: 0)?)?
agpl-1.0 | affero | affero general public license(?: version| v)? 1(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?
agpl | affero | (?:gnu )?affero general public license
agpl-3.0 | agpl | agpl ?(?:v|version )?3(?: 0)?(?: only| or later)?
apache-1.0 | apache | apache (?:software )?license(?: version| v)? 1 0
apache-1.1 | apache | apache (?:software )?license(?: version| v)? 1 1
apache-2.0 | apache | apache (?:software )?license (?:version |v)?2(?: 0)?
apache-2.0 | apache | apache 2(?: 0)?(?: license)?
apsl-2.0 | apple | apple public source license(?: version| v)?(?: 2 0)?
artistic-1.0 | artistic | (?:perl )?artistic license(?: version| v)? 1(?: 0)?
artistic-2.0 | artistic | artistic license(?: version| v)? 2(?: 0)?
artistic | artistic | (?:perl )?artistic license
beerware | beer | beer ?ware license(?: revision [0-9]+)?
bsd-1-clause | bsd | (?:bsd 1 clause|1 clause bsd|one clause bsd)(?: license)?
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: license)?
bsd-2-clause | freebsd | freebsd license
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license)?
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: license)?
bsd | bsd | bsd(?: style| like)? license
bsl-1.0 | boost | boost software license(?: version| v)?(?: 1(?: 0)?)?
bsl-1.1 | business | business source license(?: version| v)?(?: 1(?: 1)?)?
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-1.0 | cc | cc by 1 0
cc-by-2.0 | cc | cc by 2 0
cc-by-2.5 | cc | cc by 2 5
cc-by-3.0 | cc | cc by 3 0(?: unported)?
cc-by-4.0 | cc | cc by 4 0(?: international)?
cc-by-sa-2.0 | cc | cc by sa 2 0
cc-by-sa-2.5 | cc | cc by sa 2 5
cc-by-sa-3.0 | cc | cc by sa 3 0(?: unported)?
cc-by-sa-4.0 | cc | cc by sa 4 0(?: international)?
cc-by-sa | cc | cc by sa
cc-by-nd-3.0 | cc | cc by nd 3 0
cc-by-nd-4.0 | cc | cc by nd 4 0
cc-by-nd | cc | cc by nd
cc-by-nc-2.0 | cc | cc by nc 2 0
cc-by-nc-3.0 | cc | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0(?: international)?
cc-by-nc | cc | cc by nc
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0(?: international)?
cc-by-nc-sa | cc | cc by nc sa
cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0(?: international)?
cc-by-nc-nd | cc | cc by nc nd
cc-by-4.0 | creative | creative commons attribution 4 0(?: international)?(?: public)?(?: license)?
cc-by-3.0 | creative | creative commons attribution 3 0(?: unported)?(?: license)?
cc-by | creative | creative commons attribution(?: license)?
cc-by-sa | creative | creative commons attribution share ?alike(?: license)?
cc-by-sa-4.0 | creative | creative commons attribution share ?alike 4 0(?: international)?(?: license)?
cc-by-sa-3.0 | creative | creative commons attribution share ?alike 3 0(?: unported)?(?: license)?
cc-by-nd | creative | creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [0-9] 0)?
cc-by-nc | creative | creative commons attribution non ?commercial(?: license)?
cc-by-nc-4.0 | creative | creative commons attribution non ?commercial 4 0(?: international)?(?: license)?
cc-by-nc-sa | creative | creative commons attribution non ?commercial share ?alike(?: [0-9] 0)?
cc-by-nc-nd | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [0-9] 0)?
cc0-1.0 | creative | creative commons (?:zero|0)(?: 1 0)?(?: universal)?
cddl-1.0 | common | common development and distribution license(?: version| v)?(?: 1(?: 0)?)?
cecill-2.1 | cecill | cecill(?: free software)?(?: license)?(?: version| v)?(?: 2 1)?
cpl-1.0 | common | common public license(?: version| v)?(?: 1(?: 0)?)?
ecl-2.0 | educational | educational community license(?: version| v)?(?: 2 0)?
epl-1.0 | eclipse | eclipse public license(?: version| v)? 1(?: 0)?
epl-2.0 | eclipse | eclipse public license(?: version| v)? 2(?: 0)?
epl | eclipse | eclipse public license
eupl-1.1 | european | european union public licen[cs]e(?: version| v)? 1 1
eupl-1.2 | european | european union public licen[cs]e(?: version| v)? ?1 2
eupl | european | european union public licen[cs]e
gfdl-1.2 | documentation | gnu free documentation license(?: version| v)? 1 2
gfdl-1.3 | documentation | gnu free documentation license(?: version| v)? 1 3
gfdl | documentation | gnu free documentation license
gpl-1.0 | general | (?:gnu )?general public license(?: version| v)? ?1(?: 0)?
gpl-2.0 | general | (?:gnu )?general public license(?: version| v)? ?2(?: 0)?
gpl-3.0 | general | (?:gnu )?general public license(?: version| v)? ?3(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl ?(?:v|version )?2(?: 0)?(?: only| or later)?
gpl-3.0 | gpl | (?:gnu )?gpl ?(?:v|version )?3(?: 0)?(?: only| or later)?
gpl | gpl | gnu gpl
gpl-2.0 | gplv2 | gplv2
gpl-3.0 | gplv3 | gplv3
isc | isc | isc license
icu | icu | icu license
ijg | jpeg | independent jpeg group license
lgpl-2.0 | lesser | (?:gnu )?lesser general public license(?: version| v)? ?2(?: 0)?
lgpl-2.0 | library | (?:gnu )?library general public license(?: version| v)? ?2(?: 0)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public license(?: version| v)? ?2 1
lgpl-3.0 | lesser | (?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?
lgpl | lesser | (?:gnu )?lesser general public license
lgpl-2.1 | lgpl | lgpl ?(?:v|version )?2 1(?: only| or later)?
lgpl-3.0 | lgpl | lgpl ?(?:v|version )?3(?: 0)?(?: only| or later)?
lppl-1.3c | latex | latex project public license(?: version| v)?(?: 1 3c?)?
libpng | libpng | libpng license(?: version| v)?(?: 2)?
mit | mit | (?:the )?mit(?: x11| expat)? licen[cs]e
mit | expat | expat license
mit-0 | mit | mit no attribution(?: license)?
mpl-1.1 | mozilla | mozilla public license(?: version| v)? 1 1
mpl-2.0 | mozilla | mozilla public license(?: version| v)? ?2(?: 0)?
mpl | mozilla | mozilla public license
mpl-2.0 | mpl | mpl ?(?:v|version )?2(?: 0)?
ms-pl | microsoft | microsoft public license
ms-rl | microsoft | microsoft reciprocal license
mulan-psl-2.0 | mulan | mulan permissive software license(?: version| v)?(?: 2)?
ncsa | ncsa | (?:university of illinois )?ncsa open source license
odbl-1.0 | database | open (?:data commons open )?database license(?: version| v)?(?: 1 0)?
odc-by-1.0 | commons | open data commons attribution license(?: version| v)?(?: 1 0)?
ofl-1.1 | font | (?:sil )?open font license(?: version| v)?(?: 1 1)?
openssl | openssl | openssl license
osl-3.0 | open | open software license(?: version| v)?(?: 3 0)?
pddl-1.0 | dedication | public domain dedication and license(?: version| v)?(?: 1 0)?
php-3.01 | php | php license(?: version| v)?(?: 3 0 ?1)?
postgresql | postgresql | postgresql licen[cs]e
psf-2.0 | python | python software foundation license(?: version| v)?(?: 2)?
python-2.0 | python | python license(?: version| v)?(?: 2(?: 0)?)?
qpl-1.0 | public | q public license(?: version| v)?(?: 1 0)?
ruby | ruby | ruby license
sleepycat | sleepycat | sleepycat license
sspl-1.0 | server | server side public license(?: version| v)?(?: 1)?
unlicense | unlicense | (?:the )?unlicense
upl-1.0 | universal | universal permissive license(?: version| v)?(?: 1 0)?
vim | vim | vim license
w3c | w3c | w3c software(?: notice)?(?: and)? license
wtfpl | wtfpl | wtfpl
x11 | x11 | x11 license
zlib | zlib | zlib(?: libpng)? license
zpl-2.1 | zope | zope public license(?: version| v)?(?: 2 1)?
"""

# Label | beginning of a word that every match holds | sentence as pattern.
SIGNATURES = """
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | whom | to permit persons to whom the software is furnished to do so
mit | merge | use copy modify merge publish distribute sublicense and or sell copies of the software
isc | hereby | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse | neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
apache-2.0 | compliance | you may not use this file except in compliance with the license
apache-2.0 | licenses | (?:http |https )?www apache org licenses license 2 0(?: txt| html)?
apache-1.1 | foundation | this product includes software developed by the apache software foundation
gpl | redistribute | redistribute it and or modify it under the terms of the gnu general public license
gpl-2.0 | either | gnu general public license as published by the free software foundation either version 2
gpl-3.0 | either | gnu general public license as published by the free software foundation either version 3
gpl-2.0 | later | version 2 of the license or at your option any later version
gpl-3.0 | later | version 3 of the license or at your option any later version
lgpl | lesser | redistribute it and or modify it under the terms of the gnu lesser general public license
agpl | affero | redistribute it and or modify it under the terms of the gnu affero general public license
gpl | warranty | this program is distributed in the hope that it will be useful but without any warranty
gpl | gnu | see the gnu (?:lesser |affero )?general public license for more details
gpl | received | you should have received a copy of the gnu (?:lesser |affero )?general public license
gpl | gnu | (?:http |https )?www gnu org licenses(?: gpl(?: [0-9] [0-9])?)?(?: txt| html)?
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | mozilla | (?:http |https )?mozilla org mpl 2 0
epl-2.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license
epl-2.0 | eclipse | (?:http |https )?www eclipse org legal epl (?:v20|2 0)(?: html)?
bsl-1.0 | boost | distributed under the boost software license version 1 0
bsl-1.0 | boost | (?:http |https )?www boost org license 1 0 txt
zlib | altered | altered source versions must be plainly marked as such and must not be misrepresented
zlib | implied | this software is provided as is without any express or implied warranty
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | want | do what the fuck you want to public license
beerware | beer | you can buy me a beer in return
cc0-1.0 | dedicated | has dedicated the work to the public domain by waiving
cc0-1.0 | zero | (?:http |https )?creativecommons org publicdomain zero 1 0
cc-by-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons | (?:http |https )?creativecommons org licenses by 3 0
cc-by-sa-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons | (?:http |https )?creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by nc nd 4 0
cc-by-nd-4.0 | creativecommons | (?:http |https )?creativecommons org licenses by nd 4 0
public-domain | domain | (?:is|are|was|released|placed|dedicated) (?:hereby )?(?:in|into|to) the public domain
proprietary | rights | all rights reserved
proprietary | proprietary | (?:proprietary and confidential|confidential and proprietary)
proprietary | unauthorized | unauthorized (?:copying|reproduction|distribution|use) of this (?:file|software|document|work)
proprietary | written | without the (?:express )?(?:prior )?written (?:permission|consent) of
"""

#: Wording of a name: (pattern around it, priority, score).
WORDINGS = (
    ("{}", 1, 0.6),
    ("(?:licen[cs]ed|released|distributed|published|available|provided|offered) (?:freely )?under (?:the )?(?:terms of )?(?:an? |the )?{}", 2, 0.9),
    ("(?:subject to|covered by|governed by|according to|in accordance with) (?:the )?(?:terms of )?(?:an? |the )?{}", 2, 0.8),
    ("(?:spdx )?licen[cs]e(?: identifier| type| name)? {}", 2, 0.9),
)
SIGNATURE_PRIORITY, SIGNATURE_SCORE = 3, 1.0


@dataclass(frozen=True)
class Rule:
    """``core``: pattern of a whole stretch of words that every match holds; empty if there is none."""

    label: str
    keyword: str
    pattern: str
    priority: int
    score: float
    core: str = ""


def _table(text: str) -> list[list[str]]:
    return [[field.strip() for field in line.split(" | ", 2)] for line in text.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in their order: signatures first, then every name in every wording."""
    made = [Rule(*row, SIGNATURE_PRIORITY, SIGNATURE_SCORE) for row in _table(SIGNATURES)]
    for wording, priority, score in reversed(WORDINGS):
        for label, keyword, name in _table(NAMES):
            made.append(Rule(label, keyword, wording.format(f"(?:{name})"), priority, score, name))
    return made
