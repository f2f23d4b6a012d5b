"""Signature rules of licenses, in order of priority. Texts are lists of words (letters, digits, characters outside ASCII; A-Z in
lower case) joined by single spaces, so a rule never needs to care about punctuation or line breaks.

Each rule is hand-written: a label, its kind, keywords of which one must stand in the text before the rule is tried, and a pattern.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    name: str
    label: str
    kind: str
    priority: int
    keywords: frozenset[bytes]
    pattern: re.Pattern


#: Confidence of a detection by the kind of its rule, and the order in which kinds win over each other.
KINDS = {"base": (1.0, 100), "spdx": (1.0, 90), "url": (0.95, 80), "notice": (0.9, 70), "title": (0.8, 60), "clue": (0.4, 20)}

#: Phrases that always count, with their labels.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# label | keyword | SPDX words | names and notices, most telling first (an empty SPDX field: none)
TABLE = r"""
mit | mit | mit | (?:the )?mit licen[cs]e | mit x11 licen[cs]e | expat licen[cs]e | licen[cs]ed under (?:the )?mit
mit | permission | | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | mit | mit 0 | mit no attribution
x11 | x11 | x11 | x11 licen[cs]e
isc | isc | isc | isc licen[cs]e
isc | permission | | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
0bsd | bsd | 0bsd | zero clause bsd | bsd zero clause
bsd-2-clause | bsd | bsd 2 clause | (?:simplified|2 clause|two clause) bsd(?: licen[cs]e)? | bsd (?:2|two) clause(?: licen[cs]e)? | freebsd licen[cs]e
bsd-3-clause | bsd | bsd 3 clause | (?:new|modified|revised|3 clause|three clause) bsd(?: licen[cs]e)? | bsd (?:3|three) clause(?: licen[cs]e)?
bsd-3-clause | neither | | neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | bsd | bsd 4 clause | (?:original|4 clause|four clause) bsd(?: licen[cs]e)? | bsd (?:4|four) clause(?: licen[cs]e)?
bsd-4-clause | advertising | | all advertising materials mentioning features or use of this software must display
bsd | bsd | | bsd (?:style )?licen[cs]e | licen[cs]ed under (?:the )?bsd
bsd | redistribution | | redistribution and use in source and binary forms with or without modification are permitted
apache-1.0 | apache | apache 1 0 | apache (?:software )?licen[cs]e version 1 0
apache-1.1 | apache | apache 1 1 | apache (?:software )?licen[cs]e version 1 1
apache-2 | apache | apache 2 0 | (?:licen[cs]ed under (?:the )?)?apache (?:software )?licen[cs]e(?: version| v)? ?2(?: 0)? | apache 2(?: 0)? licen[cs]e | licen[cs]ed under (?:the )?apache(?: licen[cs]e)? 2
apache | apache | | apache (?:software )?licen[cs]e | licen[cs]ed under (?:the )?apache
gpl-1 | gpl | gpl 1 0 (?:only|or later) | gpl(?: version| v)? ?1(?: 0)?
gpl-2-or-later | gpl | gpl 2 0 or later | gpl(?: version| v)? ?2(?: 0)?(?: (?:or|and) (?:any )?later(?: version)?| plus)
gpl-2-only | gpl | gpl 2 0 only | gpl(?: version| v)? ?2(?: 0)? only
gpl-2 | gpl | gpl 2 0 | (?:gnu )?gpl(?: version| v)? ?2(?: 0)?
gpl-3-or-later | gpl | gpl 3 0 or later | gpl(?: version| v)? ?3(?: 0)?(?: (?:or|and) (?:any )?later(?: version)?| plus)
gpl-3-only | gpl | gpl 3 0 only | gpl(?: version| v)? ?3(?: 0)? only
gpl-3 | gpl | gpl 3 0 | (?:gnu )?gpl(?: version| v)? ?3(?: 0)?
gpl-1 | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v) ?1(?: 0)?
gpl-2-or-later | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or at your option any later version | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e(?: version| v) ?2(?: 0)? or (?:any )?later
gpl-2 | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e(?: as published by the free software foundation)?(?: version| v)? ?2(?: 0)?
gpl-3-or-later | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e(?: version| v) ?3(?: 0)? or (?:any )?later
gpl-3 | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e(?: as published by the free software foundation)?(?: version| v)? ?3(?: 0)?
gpl | general public | | (?:gnu )?(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e | gnu gpl | licen[cs]ed under (?:the )?gpl
gpl | gpl | | gnu gpl | licen[cs]ed under (?:the )?gpl | gpl licen[cs]e
lgpl-2 | lgpl | lgpl 2 0(?: only| or later)? | lgpl(?: version| v)? ?2(?: 0)?
lgpl-2.1 | lgpl | lgpl 2 1(?: only| or later)? | lgpl(?: version| v)? ?2 1
lgpl-3 | lgpl | lgpl 3 0(?: only| or later)? | lgpl(?: version| v)? ?3(?: 0)?
lgpl-2 | library general | | (?:gnu )?library general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2(?: 0)? | gnu library general public licen[cs]e
lgpl-2.1 | lesser general | | (?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2 1
lgpl-3 | lesser general | | (?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?
lgpl | lesser general | | (?:gnu )?lesser general public licen[cs]e
lgpl | lgpl | | gnu lgpl | licen[cs]ed under (?:the )?lgpl | lgpl licen[cs]e
agpl-1 | affero | agpl 1 0 | (?:gnu )?affero general public licen[cs]e(?: version| v)? ?1(?: 0)?
agpl-3 | affero | agpl 3 0(?: only| or later)? | (?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?
agpl-3 | agpl | agpl 3 0(?: only| or later)? | agpl(?: version| v)? ?3(?: 0)?
agpl | affero | | (?:gnu )?affero general public licen[cs]e
agpl | agpl | | gnu agpl | licen[cs]ed under (?:the )?agpl
gfdl-1.1 | documentation | gfdl 1 1(?: only| or later)? | (?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 1
gfdl-1.2 | documentation | gfdl 1 2(?: only| or later)? | (?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 2
gfdl-1.3 | documentation | gfdl 1 3(?: only| or later)? | (?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 3
gfdl | documentation | | (?:gnu )?free documentation licen[cs]e
gfdl | gfdl | gfdl 1 [123](?: only| or later)? | licen[cs]ed under (?:the )?gfdl
mpl-1.0 | mozilla | mpl 1 0 | mozilla public licen[cs]e(?: version| v)? ?1 0
mpl-1.1 | mozilla | mpl 1 1 | mozilla public licen[cs]e(?: version| v)? ?1 1
mpl-2 | mozilla | mpl 2 0 | mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?
mpl-2 | mpl | mpl 2 0 | mpl(?: version| v)? ?2(?: 0)?
mpl | mozilla | | mozilla public licen[cs]e
epl-1 | eclipse | epl 1 0 | eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?
epl-2 | eclipse | epl 2 0 | eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?
epl | eclipse | | eclipse public licen[cs]e
edl-1 | eclipse | | eclipse distribution licen[cs]e
cddl-1.0 | distribution | cddl 1 0 | common development and distribution licen[cs]e(?: cddl)?(?: version| v)? ?1(?: 0)?
cddl-1.1 | distribution | cddl 1 1 | common development and distribution licen[cs]e(?: cddl)?(?: version| v)? ?1 1
cddl | distribution | | common development and distribution licen[cs]e
cpl-1 | common public | cpl 1 0 | common public licen[cs]e(?: version| v)? ?1(?: 0)? | common public licen[cs]e
cpal-1 | attribution | cpal 1 0 | common public attribution licen[cs]e
ipl-1 | ibm | ipl 1 0 | ibm public licen[cs]e
apsl-2 | apple | apsl 2 0 | apple public source licen[cs]e(?: version| v)? ?2(?: 0)?
apsl-1 | apple | apsl 1 [012] | apple public source licen[cs]e(?: version| v)? ?1 [012]
artistic-1 | artistic | artistic 1 0 | artistic licen[cs]e(?: version| v)? ?1(?: 0)?
artistic-2 | artistic | artistic 2 0 | artistic licen[cs]e(?: version| v)? ?2(?: 0)?
artistic | artistic | | (?:perl )?artistic licen[cs]e | same terms as perl itself
perl | perl | | same terms as (?:the )?perl(?: 5)?(?: programming language)?(?: system)? itself
psf-2 | python | psf 2 0 | python software foundation licen[cs]e(?: version 2)? | psf licen[cs]e
python-2 | python | python 2 0 | python licen[cs]e(?: version)? ?2(?: 0)?
ruby | ruby | ruby | ruby licen[cs]e | same terms as ruby
php-3 | php | php 3 0 | php licen[cs]e(?: version| v)? ?3 0
php-3.01 | php | php 3 01 | php licen[cs]e(?: version| v)? ?3 01 | php licen[cs]e
zend-2 | zend | zend 2 0 | zend (?:engine )?licen[cs]e
tcl | tcl | tcl | tcl tk licen[cs]e | tcl licen[cs]e
lua | lua | | lua licen[cs]e
boost-1 | boost | bsl 1 0 | boost software licen[cs]e(?: version| v)?(?: 1(?: 0)?)?
zlib | zlib | zlib | zlib(?: libpng)? licen[cs]e
zlib | altered | | altered source versions must be plainly marked as such and must not be misrepresented
libpng | libpng | libpng(?: 2 0)? | libpng licen[cs]e | png reference library licen[cs]e
libtiff | libtiff | libtiff | libtiff licen[cs]e
ijg | jpeg | ijg | independent jpeg group
curl | curl | curl | curl licen[cs]e
openssl | openssl | openssl | openssl licen[cs]e | this product includes software developed by the openssl project
ssleay | ssleay | | ssleay licen[cs]e
openldap | openldap | oldap 2 8 | openldap public licen[cs]e
ntp | ntp | ntp | ntp licen[cs]e
postgresql | postgresql | postgresql | postgresql licen[cs]e
unicode-dfs | unicode | unicode dfs 201[56] | unicode (?:inc )?licen[cs]e agreement data files and software
unicode-3 | unicode | unicode 3 0 | unicode licen[cs]e(?: version| v)? ?3
icu | icu | icu | icu licen[cs]e
unlicense | unlicense | unlicense | the unlicense | unlicense licen[cs]e
unlicense | unencumbered | | free and unencumbered software released into the public domain
wtfpl | public licen | wtfpl | do what the f\w* you want to public licen[cs]e
wtfpl | wtfpl | wtfpl | wtfpl(?: version 2)?
beerware | beer | beerware | beer ?ware licen[cs]e | the beer ware
cc0-1 | cc0 | cc0 1 0 | cc0(?: 1 0)?(?: universal)?
cc0-1 | zero | | creative commons zero | public domain dedication cc0
cc-pdm-1 | public domain | | public domain mark(?: 1 0)?
cc-by-1 | cc by | cc by 1 0 | cc by 1 0
cc-by-2 | cc by | cc by 2 [05] | cc by 2 [05]
cc-by-3 | cc by | cc by 3 0 | cc by 3 0
cc-by-4 | cc by | cc by 4 0 | cc by 4 0
cc-by-sa-2 | cc by sa | cc by sa 2 [05] | cc by sa 2 [05]
cc-by-sa-3 | cc by sa | cc by sa 3 0 | cc by sa 3 0
cc-by-sa-4 | cc by sa | cc by sa 4 0 | cc by sa 4 0
cc-by-sa | cc by sa | | cc by sa
cc-by-nd-3 | cc by nd | cc by nd 3 0 | cc by nd 3 0
cc-by-nd-4 | cc by nd | cc by nd 4 0 | cc by nd 4 0
cc-by-nd | cc by nd | | cc by nd
cc-by-nc-2 | cc by nc | cc by nc 2 [05] | cc by nc 2 [05]
cc-by-nc-3 | cc by nc | cc by nc 3 0 | cc by nc 3 0
cc-by-nc-4 | cc by nc | cc by nc 4 0 | cc by nc 4 0
cc-by-nc-sa-3 | cc by nc | cc by nc sa 3 0 | cc by nc sa 3 0
cc-by-nc-sa-4 | cc by nc | cc by nc sa 4 0 | cc by nc sa 4 0
cc-by-nc-sa | cc by nc | | cc by nc sa
cc-by-nc-nd-3 | cc by nc | cc by nc nd 3 0 | cc by nc nd 3 0
cc-by-nc-nd-4 | cc by nc | cc by nc nd 4 0 | cc by nc nd 4 0
cc-by-nc-nd | cc by nc | | cc by nc nd
cc-by | creative | | creative commons attribution(?: \d(?: \d)?)?(?: international| unported| generic)?(?: public)? licen[cs]e
cc-by-sa | creative | | creative commons attribution share ?alike(?: \d \d)?
cc-by-nd | creative | | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: \d \d)?
cc-by-nc | creative | | creative commons attribution non ?commercial(?: \d \d)?
cc-by-nc-sa | creative | | creative commons attribution non ?commercial share ?alike(?: \d \d)?
cc-by-nc-nd | creative | | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: \d \d)?
cc | creative | | creative commons licen[cs]e | licen[cs]ed under (?:a )?creative commons
odbl-1 | open database | odbl 1 0 | open database licen[cs]e
odbl-1 | odbl | odbl 1 0 | licen[cs]ed under (?:the )?odbl
odc-by-1 | open data commons | odc by 1 0 | open data commons attribution licen[cs]e
pddl-1 | open data commons | pddl 1 0 | open data commons public domain dedication
cdla-permissive-2 | community data | cdla permissive 2 0 | community data licen[cs]e agreement permissive(?: version)? ?2
cdla-permissive-1 | community data | cdla permissive 1 0 | community data licen[cs]e agreement permissive
cdla-sharing-1 | community data | cdla sharing 1 0 | community data licen[cs]e agreement sharing
ogl-uk-3 | open government | ogl uk 3 0 | open government licen[cs]e(?: version| v)? ?3(?: 0)?
ogl-uk | open government | ogl uk [12] 0 | open government licen[cs]e
ofl-1.1 | open font | ofl 1 1 | sil open font licen[cs]e(?: version| v)?(?: 1 1)?
ofl-1.0 | open font | ofl 1 0 | sil open font licen[cs]e(?: version| v)? 1 0
ubuntu-font | ubuntu | | ubuntu font licen[cs]e
bitstream-vera | bitstream | bitstream vera | bitstream vera fonts copyright
eupl-1.1 | european | eupl 1 1 | european union public licen[cs]e(?: version| v)? ?1 1
eupl-1.2 | european | eupl 1 2 | european union public licen[cs]e(?: version| v)? ?1 2
eupl | european | | european union public licen[cs]e
cecill-2.1 | cecill | cecill 2 1 | cecill(?: free software)?(?: licen[cs]e)?(?: version| v)? ?2 1
cecill-b | cecill | cecill b | cecill b
cecill-c | cecill | cecill c | cecill c
cecill | cecill | cecill [12] 0 | cecill licen[cs]e | licence cecill
ms-pl | microsoft | ms pl | microsoft public licen[cs]e
ms-rl | microsoft | ms rl | microsoft reciprocal licen[cs]e
ms-eula | microsoft | | microsoft software licen[cs]e terms
afl-3 | academic | afl 3 0 | academic free licen[cs]e(?: version| v)? ?3(?: 0)?
afl | academic | afl [12] [012] | academic free licen[cs]e
osl-3 | open software | osl 3 0 | open software licen[cs]e(?: version| v)? ?3(?: 0)?
osl | open software | osl [12] [01] | open software licen[cs]e
ecl-2 | educational | ecl 2 0 | educational community licen[cs]e(?: version| v)?(?: 2(?: 0)?)?
ncsa | ncsa | ncsa | university of illinois ncsa open source licen[cs]e | ncsa open source licen[cs]e
upl-1 | universal permissive | upl 1 0 | universal permissive licen[cs]e
bluoak-1 | blue oak | blueoak 1 0 0 | blue oak model licen[cs]e
parity-7 | parity | parity 7 0 0 | parity public licen[cs]e
prosperity-3 | prosperity | | prosperity public licen[cs]e
polyform-nc-1 | polyform | polyform noncommercial 1 0 0 | polyform non ?commercial licen[cs]e
polyform-small-1 | polyform | polyform small business 1 0 0 | polyform small business licen[cs]e
elastic-2 | elastic | elastic 2 0 | elastic licen[cs]e(?: version| v)?(?: 2(?: 0)?)?
sspl-1 | server side | sspl 1 0 | server side public licen[cs]e
busl-1.1 | business source | busl 1 1 | business source licen[cs]e(?: version| v)?(?: 1 1)?
commons-clause | commons clause | | commons clause licen[cs]e condition | commons clause
json | good not evil | json | the software shall be used for good not evil
hippocratic-2.1 | hippocratic | hippocratic 2 1 | hippocratic licen[cs]e
anti-996 | 996 | | anti 996 licen[cs]e
mulan-psl-2 | mulan | mulanpsl 2 0 | mulan permissive software licen[cs]e
vim | vim | vim | vim licen[cs]e
w3c | w3c | w3c | w3c software (?:and document )?(?:notice and )?licen[cs]e
sleepycat | sleepycat | sleepycat | sleepycat (?:public )?licen[cs]e
qpl-1 | q public | qpl 1 0 | q public licen[cs]e
sissl | sun | sissl | sun industry standards source licen[cs]e
spl-1 | sun public | spl 1 0 | sun public licen[cs]e
nposl-3 | non profit | nposl 3 0 | non profit open software licen[cs]e
rpl-1.5 | reciprocal | rpl 1 5 | reciprocal public licen[cs]e
watcom-1 | watcom | watcom 1 0 | sybase open watcom public licen[cs]e
cern-ohl-p-2 | cern | cern ohl p 2 0 | cern open hardware licen[cs]e version 2 permissive
cern-ohl-s-2 | cern | cern ohl s 2 0 | cern open hardware licen[cs]e version 2 strongly reciprocal
tapr-ohl-1 | tapr | tapr ohl 1 0 | tapr open hardware licen[cs]e
openrail-m | openrail | | (?:creativeml |bigscience )?openrail ?m?(?: licen[cs]e)?
llama-2 | llama | llama 2 | llama 2 community licen[cs]e
llama-3 | llama | llama 3 | (?:meta )?llama 3(?: \d)? community licen[cs]e
gemma | gemma | | gemma terms of use
bigcode-openrail | bigcode | | bigcode open ?rail
public-domain | public domain | | (?:is|are|been) (?:released |dedicated |placed )?(?:in|into|to) the public domain | public domain dedication
proprietary | confidential | | proprietary and confidential | confidential and proprietary | unauthorized copying of this file
all-rights-reserved | reserved | | all rights reserved
"""

# keyword | words of an address | label
ADDRESSES = r"""
opensource | opensource org licen[cs]es mit | mit
opensource | opensource org licen[cs]es isc | isc
opensource | opensource org licen[cs]es bsd 2 clause | bsd-2-clause
opensource | opensource org licen[cs]es bsd 3 clause | bsd-3-clause
opensource | opensource org licen[cs]es apache 2 0 | apache-2
opensource | opensource org licen[cs]es zlib | zlib
opensource | opensource org licen[cs]es artistic 2 0 | artistic-2
opensource | opensource org licen[cs]es ms pl | ms-pl
apache org | (?:www )?apache org licen[cs]es licen[cs]e 2 0 | apache-2
apache org | (?:www )?apache org licen[cs]es licen[cs]e 1 1 | apache-1.1
gnu org | (?:www )?gnu org licen[cs]es gpl 2 0 | gpl-2
gnu org | (?:www )?gnu org licen[cs]es gpl 3 0 | gpl-3
gnu org | (?:www )?gnu org licen[cs]es old licen[cs]es gpl 2 0 | gpl-2
gnu org | (?:www )?gnu org licen[cs]es lgpl 2 1 | lgpl-2.1
gnu org | (?:www )?gnu org licen[cs]es lgpl 3 0 | lgpl-3
gnu org | (?:www )?gnu org licen[cs]es agpl 3 0 | agpl-3
gnu org | (?:www )?gnu org licen[cs]es fdl 1 3 | gfdl-1.3
gnu org | (?:www )?gnu org licen[cs]es gpl | gpl
gnu org | (?:www )?gnu org copyleft gpl | gpl
gnu org | (?:www )?gnu org copyleft lesser | lgpl
mozilla org | (?:www )?mozilla org mpl 2 0 | mpl-2
mozilla org | (?:www )?mozilla org mpl mpl 1 1 | mpl-1.1
eclipse org | (?:www )?eclipse org legal epl 2 0 | epl-2
eclipse org | (?:www )?eclipse org legal epl v10 | epl-1
boost org | (?:www )?boost org license 1 0 txt | boost-1
unlicense org | unlicense org | unlicense
creativecommons | creativecommons org publicdomain zero 1 0 | cc0-1
creativecommons | creativecommons org publicdomain mark 1 0 | cc-pdm-1
creativecommons | creativecommons org licen[cs]es by 2 [05] | cc-by-2
creativecommons | creativecommons org licen[cs]es by 3 0 | cc-by-3
creativecommons | creativecommons org licen[cs]es by 4 0 | cc-by-4
creativecommons | creativecommons org licen[cs]es by sa 3 0 | cc-by-sa-3
creativecommons | creativecommons org licen[cs]es by sa 4 0 | cc-by-sa-4
creativecommons | creativecommons org licen[cs]es by nd 4 0 | cc-by-nd-4
creativecommons | creativecommons org licen[cs]es by nc 3 0 | cc-by-nc-3
creativecommons | creativecommons org licen[cs]es by nc 4 0 | cc-by-nc-4
creativecommons | creativecommons org licen[cs]es by nc sa 3 0 | cc-by-nc-sa-3
creativecommons | creativecommons org licen[cs]es by nc sa 4 0 | cc-by-nc-sa-4
creativecommons | creativecommons org licen[cs]es by nc nd 3 0 | cc-by-nc-nd-3
creativecommons | creativecommons org licen[cs]es by nc nd 4 0 | cc-by-nc-nd-4
opendatacommons | opendatacommons org licen[cs]es odbl | odbl-1
opendatacommons | opendatacommons org licen[cs]es by | odc-by-1
opendatacommons | opendatacommons org licen[cs]es pddl | pddl-1
scripts sil | scripts sil org ofl | ofl-1.1
"""

# keyword | clue | label of last resort
CLUES = r"""
licen | see (?:the )?(?:file )?licen[cs]e(?: txt| md)? (?:file )?for (?:more )?details | unknown-license-reference
licen | (?:this|the) (?:work|software|program|library|document|text|code) is licen[cs]ed under | unknown-license-reference
licen | distributed under the terms of | unknown-license-reference
licen | licen[cs]ed under the terms of | unknown-license-reference
licen | subject to the terms of the licen[cs]e | unknown-license-reference
licen | released under (?:the|an?) [^ ]+ licen[cs]e | unknown-license-reference
licen | licen[cs]e agreement | unknown-license-reference
copyleft | copyleft | unknown-copyleft
"""


def _compile(body: str) -> re.Pattern:
    return re.compile(rb"(?<= )(?:" + body.replace("(?: version| v)", "(?: version| ?v)").encode() + rb")(?= )")


def gate(keyword: str) -> frozenset[bytes]:
    """The words of which one must stand in the text: the keyword's first word, with its written forms."""
    first = keyword.split()[0]
    if first == "licen":
        forms = [f"licen{c}e{end}" for c in "cs" for end in ("", "d", "s")]
    elif first.endswith(("gpl", "mpl")):
        forms = [first + end for end in ("", "v1", "v2", "v3", "1", "2", "3")]
    else:
        forms = [first]
    return frozenset(f.encode() for f in forms)


def rules() -> tuple[Rule, ...]:
    """All rules, the winning ones first: kinds in their order, then the order of the tables."""
    found: list[tuple[str, str, str, str]] = [(label, "base", label.split("-")[0], phrase) for phrase, label in BASE_PHRASES]
    for line in filter(None, TABLE.splitlines()):
        label, keyword, spdx, *names = (x.strip() for x in re.split(r" \|(?= |$)", line))
        if spdx:
            found.append((label, "spdx", keyword.split()[0] if keyword.split()[0] in spdx else "spdx",
                          rf"spdx licen[cs]e identifier {spdx}"))
        found += [(label, "notice" if len(name) > 60 else "title", keyword, name) for name in names if name]
    found += [(label, "url", keyword, address) for keyword, address, label in
              ([x.strip() for x in line.split(" | ")] for line in filter(None, ADDRESSES.splitlines()))]
    found += [(label, "clue", keyword, clue) for keyword, clue, label in
              ([x.strip() for x in line.split(" | ")] for line in filter(None, CLUES.splitlines()))]
    order = sorted(range(len(found)), key=lambda k: (-KINDS[found[k][1]][1], k))
    return tuple(Rule(f"{kind}-{label}-{k}", label, kind, KINDS[kind][1], gate(keyword), _compile(body))
                 for k in order for label, kind, keyword, body in [found[k]])
