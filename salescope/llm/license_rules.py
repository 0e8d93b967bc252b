"""Signature rules of the license scan.

One rule a line: label, priority, keywords, pattern.  Patterns read a text as its
lower-case words (runs of letters and digits) with one blank between them, and
match whole words only; the keywords are words that every match holds.  Priority
4 is a formal identifier or notice, 3 a passage of a license's own text, 2 a
name with its version, 1 a name alone, 0 a hint.  ``~v`` stands for an optional
"version", ``~l`` for "license" in either spelling, ``~g`` for the "gnu" family's
optional prefix words, ``~c`` for "creative commons".
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: What a surviving detection of each priority adds to the score.
WEIGHTS = (0.3, 0.6, 0.85, 0.9, 0.98)

_SHORT = {"~v": r"(?:version |v ?)?", "~l": r"licen[cs]es?", "~g": r"(?:the )?(?:gnu )?", "~c": r"(?:creative commons|cc)"}

_RULES = r"""
gpl-1.0 | 4 | spdx | spdx ~l identifier gpl 1 0(?: only| or later)?
gpl-2.0-only | 4 | spdx | spdx ~l identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 4 | spdx | spdx ~l identifier gpl 2 0 or later
gpl-3.0-only | 4 | spdx | spdx ~l identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 4 | spdx | spdx ~l identifier gpl 3 0 or later
lgpl-2.1 | 4 | spdx | spdx ~l identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 4 | spdx | spdx ~l identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | 4 | spdx | spdx ~l identifier agpl 3 0(?: only| or later)?
apache-2.0 | 4 | spdx | spdx ~l identifier apache 2 0
mit | 4 | spdx | spdx ~l identifier mit
mit-0 | 4 | spdx | spdx ~l identifier mit 0
bsd-2-clause | 4 | spdx | spdx ~l identifier bsd 2 clause
bsd-3-clause | 4 | spdx | spdx ~l identifier bsd 3 clause
0bsd | 4 | spdx | spdx ~l identifier 0bsd
isc | 4 | spdx | spdx ~l identifier isc
mpl-2.0 | 4 | spdx | spdx ~l identifier mpl 2 0
epl-2.0 | 4 | spdx | spdx ~l identifier epl 2 0
eupl-1.2 | 4 | spdx | spdx ~l identifier eupl 1 2
cc0-1.0 | 4 | spdx | spdx ~l identifier cc0 1 0
cc-by-4.0 | 4 | spdx | spdx ~l identifier cc by 4 0
cc-by-sa-4.0 | 4 | spdx | spdx ~l identifier cc by sa 4 0
cc-by-nc-4.0 | 4 | spdx | spdx ~l identifier cc by nc 4 0
unlicense | 4 | spdx | spdx ~l identifier unlicense
zlib | 4 | spdx | spdx ~l identifier zlib
bsl-1.0 | 4 | spdx | spdx ~l identifier bsl 1 0
spdx-tag | 1 | spdx | spdx ~l identifier \S+
gpl-1.0 | 2 | general public | ~ggeneral public ~l ~v1(?: 0)?
gpl-2.0 | 2 | general public | ~ggeneral public ~l ~v2(?: 0)?
gpl-3.0 | 2 | general public | ~ggeneral public ~l ~v3(?: 0)?
gpl-2.0-or-later | 4 | general public | general public ~l as published by the free software foundation either version 2 of the ~l or at your option any later version
gpl-3.0-or-later | 4 | general public | general public ~l as published by the free software foundation either version 3 of the ~l or at your option any later version
gpl-2.0-only | 4 | general public | general public ~l as published by the free software foundation version 2(?: of the ~l)?
gpl-2.0-or-later | 3 | general public | ~ggeneral public ~l ~v2(?: 0)? or (?:at your option )?(?:any )?later
gpl-3.0-or-later | 3 | general public | ~ggeneral public ~l ~v3(?: 0)? or (?:at your option )?(?:any )?later
gpl | 1 | general public | ~ggeneral public ~l
gpl-2.0 | 2 | gplv2 | gplv2(?: 0)?
gpl-2.0-or-later | 3 | gplv2 | gplv2(?: 0)? (?:or later|plus)
gpl-3.0 | 2 | gplv3 | gplv3(?: 0)?
gpl-3.0-or-later | 3 | gplv3 | gplv3(?: 0)? (?:or later|plus)
gpl-2.0 | 2 | gpl | gpl ~v2(?: 0)?
gpl-2.0-or-later | 3 | gpl | gpl ~v2(?: 0)? or later
gpl-3.0 | 2 | gpl | gpl ~v3(?: 0)?
gpl-3.0-or-later | 3 | gpl | gpl ~v3(?: 0)? or later
gpl | 1 | gpl | (?:gnu )?gpl
gpl | 3 | copyleft | this is free software and (?:it )?is copyleft
gpl | 3 | program absolutely warranty | this program comes with absolutely no warranty
gpl | 3 | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public ~l
classpath-exception-2.0 | 3 | linking | linking this library statically or dynamically with other modules is making a combined work
gcc-exception-3.1 | 2 | runtime | gcc runtime library exception(?: ~v3 1)?
lgpl-2.0 | 2 | library general public | ~glibrary general public ~l(?: ~v2(?: 0)?)?
lgpl-2.1 | 2 | lesser | ~glesser general public ~l ~v2 1
lgpl-3.0 | 2 | lesser | ~glesser general public ~l ~v3(?: 0)?
lgpl-2.1-or-later | 4 | lesser | lesser general public ~l as published by the free software foundation either version 2 1 of the ~l or at your option any later version
lgpl-3.0-or-later | 4 | lesser | lesser general public ~l as published by the free software foundation either version 3 of the ~l or at your option any later version
lgpl | 1 | lesser | ~glesser general public ~l
lgpl-2.1 | 2 | lgpl | lgpl ~v2 1
lgpl-3.0 | 2 | lgpl | lgpl ~v3(?: 0)?
lgpl | 1 | lgpl | (?:gnu )?lgpl
lgpl-2.1 | 2 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
agpl-3.0 | 2 | affero | ~gaffero general public ~l ~v3(?: 0)?
agpl-3.0-or-later | 4 | affero | affero general public ~l as published by the free software foundation either version 3 of the ~l or at your option any later version
agpl-1.0 | 2 | affero | affero general public ~l ~v1(?: 0)?
agpl | 1 | affero | ~gaffero general public ~l
agpl-3.0 | 2 | agplv3 | agplv3
agpl | 1 | agpl | (?:gnu )?agpl(?: ~v3(?: 0)?)?
agpl | 3 | remote network interaction | remote network interaction use with the gnu general public ~l
gfdl-1.1 | 2 | free documentation | ~gfree documentation ~l ~v1 1
gfdl-1.2 | 2 | free documentation | ~gfree documentation ~l ~v1 2
gfdl-1.3 | 2 | free documentation | ~gfree documentation ~l ~v1 3
gfdl | 1 | free documentation | ~gfree documentation ~l
gfdl | 1 | gfdl | gfdl(?: 1 [123])?
apache-2.0 | 4 | apache | licensed under the apache ~l ~v2 0 the ~l
apache-2.0 | 3 | apache | you may obtain a copy of the ~l at https? www apache org ~l license 2 0
apache-2.0 | 2 | apache | apache (?:software )?(?:~l )?~v2(?: 0)?(?: ~l)?
apache-1.1 | 2 | apache | apache (?:software )?(?:~l )?~v1 1
apache-1.0 | 2 | apache | apache (?:software )?(?:~l )?~v1 0
apache | 1 | apache | apache (?:software )?~l
apache-2.0 | 3 | notwithstanding | grant of patent ~l subject to the terms and conditions of this ~l (?:\S+ ){0,60}notwithstanding
apache-2.0 | 2 | asl | asl ~v2(?: 0)?
mit | 2 | mit | (?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit ~l
mit | 1 | mit | (?:the )?mit ~l
mit | 1 | expat | (?:the )?expat ~l
mit | 3 | sublicense | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:\S+ ){0,40}sublicense
mit | 3 | noninfringement | merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
mit-0 | 2 | attribution | mit no attribution(?: ~l)?
x11 | 2 | x11 | (?:the )?(?:mit )?x11 ~l
x11 | 3 | consortium | except as contained in this notice the name of the x consortium shall not be used
bsd-4-clause | 3 | acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-3-clause | 3 | endorse | neither the name of (?:\S+ ){1,20}may be used to endorse or promote products derived from this software
bsd-2-clause | 3 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-1-clause | 2 | clause | (?:bsd 1 clause|1 clause bsd)(?: ~l)?
bsd-2-clause | 2 | clause | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: ~l)?
bsd-3-clause | 2 | clause | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: ~l)?
bsd-4-clause | 2 | clause | (?:bsd 4 clause|4 clause bsd|four clause bsd)(?: ~l)?
bsd-3-clause | 2 | bsd | (?:the )?(?:new|modified|revised) bsd ~l
bsd-2-clause | 2 | bsd | (?:the )?(?:simplified|freebsd) bsd ~l
bsd-4-clause | 2 | bsd | (?:the )?(?:original|old) bsd ~l
bsd | 1 | bsd | (?:the )?bsd(?: style)? ~l
0bsd | 2 | 0bsd | 0bsd(?: ~l)?
0bsd | 2 | zero clause bsd | zero clause bsd(?: ~l)?
isc | 3 | permission purpose fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 1 | isc | (?:the )?isc ~l
mpl-1.0 | 2 | mozilla | mozilla public ~l ~v1(?: 0)?
mpl-1.1 | 2 | mozilla | mozilla public ~l ~v1 1
mpl-2.0 | 2 | mozilla | mozilla public ~l ~v2(?: 0)?
mpl-2.0 | 4 | mozilla | this source code form is subject to the terms of the mozilla public ~l ~v2 0
mpl | 1 | mozilla | mozilla public ~l
mpl-2.0 | 2 | mpl | mpl ~v2(?: 0)?
mpl-1.1 | 2 | mpl | mpl ~v1 1
epl-1.0 | 2 | eclipse | eclipse public ~l ~v1(?: 0)?
epl-2.0 | 2 | eclipse | eclipse public ~l ~v2(?: 0)?
epl | 1 | eclipse | eclipse public ~l
edl-1.0 | 2 | eclipse | eclipse distribution ~l ~v1(?: 0)?
epl-2.0 | 2 | epl | epl ~v2(?: 0)?
epl-1.0 | 2 | epl | epl ~v1(?: 0)?
cpl-1.0 | 2 | common public | common public ~l(?: ~v1(?: 0)?)?
ipl-1.0 | 2 | ibm | ibm public ~l(?: ~v1(?: 0)?)?
cpal-1.0 | 2 | attribution | common public attribution ~l(?: ~v1(?: 0)?)?
cddl-1.0 | 2 | cddl | cddl ~v1(?: 0)?
cddl-1.1 | 2 | cddl | cddl ~v1 1
cddl | 1 | common development and distribution | common development and distribution ~l
cddl-1.0 | 2 | common development and distribution | common development and distribution ~l ~v1(?: 0)?
eupl-1.1 | 2 | eupl | eupl ~v1 1
eupl-1.2 | 2 | eupl | eupl ~v1 2
eupl | 1 | european | european union public ~l
eupl-1.2 | 2 | european | european union public ~l ~v1 2
osl-3.0 | 2 | open software | open software ~l(?: ~v3(?: 0)?)?
afl-3.0 | 2 | academic | academic free ~l(?: ~v3(?: 0)?)?
ecl-2.0 | 2 | educational | educational community ~l(?: ~v2(?: 0)?)?
rpl-1.5 | 2 | reciprocal | reciprocal public ~l(?: ~v1 5)?
ms-pl | 2 | microsoft | microsoft public ~l
ms-rl | 2 | microsoft | microsoft reciprocal ~l
qpl-1.0 | 2 | q public | q public ~l(?: ~v1(?: 0)?)?
lppl-1.3c | 2 | latex | latex project public ~l(?: ~v1 3c?)?
lppl | 1 | lppl | lppl(?: ~v1 [0123]c?)?
artistic-1.0 | 2 | artistic | artistic ~l ~v1(?: 0)?
artistic-2.0 | 2 | artistic | artistic ~l ~v2(?: 0)?
artistic | 1 | artistic | artistic ~l
perl | 2 | perl | (?:under )?the same terms as perl(?: itself)?
python-2.0 | 2 | python | python (?:software foundation )?~l(?: ~v2(?: 0)?)?
psf-2.0 | 2 | psf | psf ~l(?: agreement)?
php-3.01 | 2 | php | php ~l(?: ~v3 01)?
ruby | 2 | ruby | (?:the )?ruby ~l
zlib | 2 | zlib | zlib(?: libpng)? ~l
zlib | 3 | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng | 2 | libpng | libpng ~l
bsl-1.0 | 2 | boost | boost software ~l(?: ~v1(?: 0)?)?
bsl-1.0 | 3 | boost | distributed under the boost software ~l ~v1 0
openssl | 2 | openssl | openssl ~l
openssl | 3 | openssl | this product includes software developed by the openssl project
curl | 2 | curl | curl ~l
ncsa | 2 | ncsa | (?:university of illinois )?ncsa(?: open source)? ~l
zpl-2.1 | 2 | zope | zope public ~l(?: ~v2 1)?
w3c | 2 | w3c | w3c software(?: notice and)?(?: document)? ~l
sleepycat | 2 | sleepycat | sleepycat ~l
postgresql | 2 | postgresql | postgresql ~l
vim | 2 | vim | vim ~l
icu | 2 | icu | icu ~l
unicode-dfs | 2 | unicode | unicode (?:data files and software )?~l(?: agreement)?
ijg | 3 | jpeg | this software is based in part on the work of the independent jpeg group
ofl-1.1 | 2 | sil | sil open font ~l(?: ~v1 1)?
ofl-1.1 | 2 | ofl | ofl ~v1 1
bitstream-vera | 2 | bitstream | bitstream vera(?: fonts?)? (?:~l|copyright)
upl-1.0 | 2 | universal permissive | universal permissive ~l(?: ~v1(?: 0)?)?
mulan-psl-2.0 | 2 | mulan | mulan (?:psl|permissive software ~l)(?: ~v2(?: 0)?)?
cecill-2.1 | 2 | cecill | cecill(?: free software)?(?: ~l)?(?: ~v2(?: [01])?)?
cecill-b | 3 | cecill | cecill b(?: ~l)?
cecill-c | 3 | cecill | cecill c(?: ~l)?
nasa-1.3 | 2 | nasa | nasa open source agreement(?: ~v1 3)?
ipa | 2 | ipa | ipa font ~l
intel | 2 | intel | intel open source ~l
wtfpl | 2 | wtfpl | wtfpl(?: ~v2)?
wtfpl | 2 | fuck | do what the fuck you want to public ~l
beerware | 2 | beerware | (?:the )?beerware ~l
beerware | 2 | beer | (?:the )?beer ware ~l
json | 3 | evil | the software shall be used for good not evil
unlicense | 2 | unlicense | (?:the )?unlicense
unlicense | 3 | unencumbered | this is free and unencumbered software released into the public domain
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | zero | ~c zero(?: ~l)?(?: 1 0)?
public-domain-mark | 2 | public domain mark | public domain mark(?: 1 0)?
public-domain | 1 | the public domain | (?:in|into|to) the public domain
pddl-1.0 | 2 | dedication | public domain dedication and ~l
odbl-1.0 | 2 | odbl | odbl(?: ~v1 0)?
odbl-1.0 | 2 | open database | open database ~l(?: ~v1 0)?
odc-by-1.0 | 2 | commons | open data commons attribution ~l
cc-by-1.0 | 2 | cc by | cc by 1 0
cc-by-2.0 | 2 | cc by | cc by 2 0
cc-by-2.5 | 2 | cc by | cc by 2 5
cc-by-3.0 | 2 | cc by | cc by 3 0
cc-by-4.0 | 2 | cc by | cc by 4 0
cc-by-sa-2.0 | 3 | cc by sa | cc by sa 2 0
cc-by-sa-2.5 | 3 | cc by sa | cc by sa 2 5
cc-by-sa-3.0 | 3 | cc by sa | cc by sa 3 0
cc-by-sa-4.0 | 3 | cc by sa | cc by sa 4 0
cc-by-nc-2.0 | 3 | cc by nc | cc by nc 2 0
cc-by-nc-3.0 | 3 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 3 | cc by nc | cc by nc 4 0
cc-by-nd-3.0 | 3 | cc by nd | cc by nd 3 0
cc-by-nd-4.0 | 3 | cc by nd | cc by nd 4 0
cc-by-nc-sa-3.0 | 3 | cc by sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 3 | cc by sa | cc by nc sa 4 0
cc-by-nc-nd-3.0 | 3 | cc by nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 3 | cc by nd | cc by nc nd 4 0
cc-by | 1 | cc by | cc by
cc-by-sa | 2 | cc by sa | cc by sa
cc-by-nc | 2 | cc by nc | cc by nc
cc-by-nd | 2 | cc by nd | cc by nd
cc-by-nc-sa | 2 | cc by sa | cc by nc sa
cc-by-nc-nd | 2 | cc by nd | cc by nc nd
cc-by-4.0 | 3 | attribution | ~c attribution (?:4 0(?: international)?)(?: ~l)?
cc-by-3.0 | 3 | attribution | ~c attribution (?:3 0(?: unported)?)(?: ~l)?
cc-by | 1 | attribution | ~c attribution(?: ~l)?
cc-by-sa-4.0 | 3 | sharealike | ~c attribution sharealike 4 0(?: international)?
cc-by-sa-3.0 | 3 | sharealike | ~c attribution sharealike 3 0(?: unported)?
cc-by-sa | 2 | sharealike | ~c attribution sharealike(?: ~l)?
cc-by-sa | 2 | alike | ~c attribution share alike(?: ~l)?(?: [1234] [05])?
cc-by-nc-4.0 | 3 | noncommercial | ~c attribution noncommercial 4 0(?: international)?
cc-by-nc | 2 | noncommercial | ~c attribution noncommercial(?: ~l)?
cc-by-nc-sa | 3 | noncommercial | ~c attribution noncommercial sharealike(?: [1234] [05])?
cc-by-nc-nd | 3 | noderivatives | ~c attribution noncommercial noderivatives(?: [1234] [05])?
cc-by-nd | 3 | noderivatives | ~c attribution noderivatives(?: [1234] [05])?
creative-commons | 1 | creative | creative commons(?: ~l)?
sspl-1.0 | 2 | server side public | server side public ~l(?: ~v1(?: 0)?)?
sspl-1.0 | 2 | sspl | sspl(?: ~v1(?: 0)?)?
busl-1.1 | 2 | business source | business source ~l(?: ~v?1 1)?
elastic-2.0 | 2 | elastic | elastic ~l(?: ~v2(?: 0)?)?
commons-clause | 2 | clause | commons clause(?: ~l)?(?: condition)?
polyform | 2 | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter)(?: ~l)?
hippocratic | 2 | hippocratic | hippocratic ~l(?: ~v[123](?: [01])?)?
openrail | 2 | openrail | (?:bigscience |creativeml )?openrail(?: m)?(?: ~l)?
llama-community | 2 | llama | llama [234](?: [123])? community ~l(?: agreement)?
gemma-terms | 2 | gemma | gemma terms of use
ethical-use | 1 | responsible | responsible ai ~l
oracle-bcl | 2 | oracle binary code | oracle binary code ~l(?: agreement)?
sun-bcl | 2 | sun binary code | sun (?:microsystems )?binary code ~l(?: agreement)?
apple-psl-2.0 | 2 | apple public source | apple public source ~l(?: ~v2(?: 0)?)?
nokia-open | 2 | nokia | nokia open source ~l
sissl | 2 | sun industry standards source | sun industry standards source ~l
watcom-1.0 | 2 | watcom | sybase open watcom public ~l
motosoto | 2 | motosoto | motosoto open source ~l
eula | 1 | end user agreement | end user ~l agreement
eula | 1 | eula | eula
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 1 | proprietary | proprietary (?:software|~l|information)
proprietary | 3 | unauthorized | unauthorized (?:copying|reproduction|use|distribution) (?:\S+ ){0,12}(?:strictly )?prohibited
proprietary | 1 | redistribute | (?:may|must) not (?:copy|modify|sell)(?: \S+){0,6} redistribute
non-commercial | 1 | non commercial | (?:for )?non commercial (?:use|purposes?)(?: only)?
non-commercial | 1 | noncommercial | noncommercial (?:use|purposes?)(?: only)?
research-only | 1 | for research only | for research (?:use|purposes?) only
freeware | 1 | freeware | (?:this (?:software|program) is )?freeware
shareware | 1 | shareware | (?:this (?:software|program) is )?shareware
dual-license | 1 | dual | dual licen[cs]ed
all-rights-reserved | 2 | reserved | copyright (?:c )?(?:\d{4} )?(?:\S+ ){0,8}all rights reserved
all-rights-reserved | 1 | reserved | all rights reserved
some-rights-reserved | 1 | reserved | some rights reserved
copyright-notice | 0 | copyright | copyright (?:c )?\d{4}
license-reference | 0 | see the file | see the ~l file
license-reference | 0 | licensed | licensed under(?: the)?
"""


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: frozenset[bytes]
    pattern: re.Pattern[bytes]


def parse_rules(lines: str) -> list[Rule]:
    out = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        label, priority, keywords, pattern = line.split(" | ", 3)
        for short, long in _SHORT.items():
            pattern = pattern.replace(short, long)
        out.append(Rule(label, int(priority), frozenset(keywords.encode().split()),
                        re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())))
    return out


RULES = parse_rules(_RULES)
