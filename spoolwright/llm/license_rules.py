"""Signature rules of licences: a label, a kind and a regular expression over lower-cased words with single spaces.

A rule's first word is its keyword: the rule is tried only where that word stands, and from there on. Expressions use groups, alternatives,
options and bounded repeats only. Order matters: of two rules of a kind that fit the same words, the first one tells.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Kinds from the strongest to the weakest, with how sure a detection is.
KINDS = {"tag": 1.0, "text": 0.95, "grant": 0.9, "url": 0.8, "name": 0.7, "mention": 0.4}
#: No rule may match more words than this.
WINDOW = 24

#: Phrases that every scan counts, whatever else is found at their place. Fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

RULES = r"""
mit              tag      spdx license identifier mit
apache-2.0       tag      spdx license identifier apache 2 0
apache-1.1       tag      spdx license identifier apache 1 1
gpl-1.0          tag      spdx license identifier gpl 1 0( only| or later)?
gpl-2.0          tag      spdx license identifier gpl 2 0( only)?
gpl-2.0-or-later tag      spdx license identifier gpl 2 0 or later
gpl-3.0          tag      spdx license identifier gpl 3 0( only)?
gpl-3.0-or-later tag      spdx license identifier gpl 3 0 or later
lgpl-2.0         tag      spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1         tag      spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0         tag      spdx license identifier lgpl 3 0( only| or later)?
agpl-3.0         tag      spdx license identifier agpl 3 0( only| or later)?
bsd-2-clause     tag      spdx license identifier bsd 2 clause( patent| views)?
bsd-3-clause     tag      spdx license identifier bsd 3 clause( clear| lbnl)?
bsd-4-clause     tag      spdx license identifier bsd 4 clause( uc)?
0bsd             tag      spdx license identifier 0bsd
isc              tag      spdx license identifier isc
mpl-1.1          tag      spdx license identifier mpl 1 1
mpl-2.0          tag      spdx license identifier mpl 2 0
epl-1.0          tag      spdx license identifier epl 1 0
epl-2.0          tag      spdx license identifier epl 2 0
cddl-1.0         tag      spdx license identifier cddl 1 [01]
eupl-1.1         tag      spdx license identifier eupl 1 1
eupl-1.2         tag      spdx license identifier eupl 1 2
cc0-1.0          tag      spdx license identifier cc0 1 0
cc-by-3.0        tag      spdx license identifier cc by 3 0
cc-by-4.0        tag      spdx license identifier cc by 4 0
cc-by-sa-3.0     tag      spdx license identifier cc by sa 3 0
cc-by-sa-4.0     tag      spdx license identifier cc by sa 4 0
cc-by-nc-4.0     tag      spdx license identifier cc by nc 4 0
cc-by-nd-4.0     tag      spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0  tag      spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0  tag      spdx license identifier cc by nc nd 4 0
unlicense        tag      spdx license identifier unlicense
wtfpl            tag      spdx license identifier wtfpl
zlib             tag      spdx license identifier zlib
bsl-1.0          tag      spdx license identifier bsl 1 0
artistic-2.0     tag      spdx license identifier artistic 2 0
postgresql       tag      spdx license identifier postgresql
python-2.0       tag      spdx license identifier (python|psf) 2 0
ofl-1.1          tag      spdx license identifier ofl 1 1
ncsa             tag      spdx license identifier ncsa
gfdl-1.3         tag      spdx license identifier gfdl 1 [23]( only| or later)?
odbl-1.0         tag      spdx license identifier odbl 1 0
mulan-psl-2.0    tag      spdx license identifier mulanpsl 2 0
proprietary      tag      spdx license identifier licenseref proprietary
custom           tag      spdx license identifier licenseref [^ ]+

mit              text     permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit              text     the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
isc              text     permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted
hpnd             text     permission to use copy modify and distribute this software and its documentation for any purpose( and)?( without fee)? is hereby granted
0bsd             text     permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
bsd              text     redistribution and use in source and binary forms with or without modification are permitted( provided that the following conditions are met)?
bsd-3-clause     text     neither the name of [^ ]+( [^ ]+){0,8} nor the names of (its|their) contributors may be used to endorse or promote products
bsd-4-clause     text     all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2-clause     text     redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
zlib             text     altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0          text     boost software license version 1 0 august 17( th)? 2003
apache-2.0       text     unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0       text     terms and conditions for use reproduction and distribution 1 definitions license shall mean
gpl              text     everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl-2.0          text     gnu general public license version 2 june 1991
gpl-3.0          text     gnu general public license version 3 29 june 2007
lgpl-2.1         text     gnu lesser general public license version 2 1 february 1999
lgpl-2.0         text     gnu library general public license version 2 june 1991
lgpl-3.0         text     gnu lesser general public license version 3 29 june 2007
agpl-3.0         text     gnu affero general public license version 3 19 november 2007
gfdl-1.3         text     gnu free documentation license version 1 3 3 november 2008
gpl-2.0-or-later text     either version 2 of the license or at your option any later version
gpl-3.0-or-later text     either version 3 of the license or at your option any later version
lgpl-2.1         text     either version 2 1 of the license or at your option any later version
mpl-2.0          text     source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1          text     contents of this file are subject to the mozilla public license version 1 1
epl-1.0          text     accompanying materials are made available under the terms of the eclipse public license v1( 0)?
epl-2.0          text     accompanying materials are made available under the terms of the eclipse public license( v)? 2 0
cddl-1.0         text     contents of this file are subject to the terms of the common development and distribution license
unlicense        text     anyone is free to copy modify publish use compile sell or distribute this software either in source code form
unlicense        text     free and unencumbered software released into the public domain
wtfpl            text     everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed
beerware         text     you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it
cc0-1.0          text     creative commons legal code cc0 1 0 universal
cc0-1.0          text     waived all copyright and related or neighboring rights
ofl-1.1          text     font software is licensed under the sil open font license version 1 1
php-3.01         text     source file is subject to version 3 01 of the php license
ruby             text     you may modify your copy of the software in any way provided that you do at least one of the following
public-domain    text     placed (in|into) the public domain( by [^ ]+( [^ ]+){0,3})?
public-domain    text     dedicated to the public domain
proprietary      text     unauthorized (copying|use|reproduction|distribution)( [^ ]+){0,8} is strictly prohibited
proprietary      text     confidential and proprietary( information)?
all-rights       text     all rights reserved
all-rights       text     no part of this (publication|book|work|document) may be reproduced( [^ ]+){0,12} without( the)?( prior)? written permission
all-rights       text     todos los derechos reservados
all-rights       text     tous droits réservés
all-rights       text     alle rechte vorbehalten

gpl-1.0          grant    licensed under( the)?( terms of the)? gnu general public license version 1( 0)?
gpl-2.0          grant    licensed under( the)?( terms of the)? gnu general public license( version| v)? ?2( 0)?( only)?
gpl-3.0          grant    licensed under( the)?( terms of the)? gnu general public license( version| v)? ?3( 0)?( only)?
gpl              grant    licensed under( the)?( terms of the)? gnu general public license
gpl-2.0          grant    licensed under( the)? gpl ?v?2( 0)?
gpl-3.0          grant    licensed under( the)? gpl ?v?3( 0)?
gpl              grant    licensed under( the)? gpl
lgpl-2.1         grant    licensed under( the)?( terms of the)? (gnu lesser general public license|lgpl)( version| v)? ?2 1
lgpl-3.0         grant    licensed under( the)?( terms of the)? (gnu lesser general public license|lgpl)( version| v)? ?3( 0)?
lgpl             grant    licensed under( the)?( terms of the)? (gnu (lesser|library) general public license|lgpl)
agpl-3.0         grant    licensed under( the)?( terms of the)? (gnu affero general public license|agpl)( version| v)? ?3( 0)?
agpl             grant    licensed under( the)?( terms of the)? (gnu affero general public license|agpl)
apache-2.0       grant    licensed under( the)?( terms of the)? apache( software)? license,?( version| v)? ?2( 0)?
apache-1.1       grant    licensed under( the)?( terms of the)? apache( software)? license( version)? 1 1
apache           grant    licensed under( the)?( terms of the)? apache( software)? license
apache-2.0       grant    licensed under apache ?v?2( 0)?
mit              grant    licensed under( the)?( terms of the)? mit( x11| expat)?( style)?( open source)? licen[cs]e
mit              grant    licensed under( the)? mit
bsd-2-clause     grant    licensed under( the)?( terms of the)? (2|two) clause bsd licen[cs]e
bsd-3-clause     grant    licensed under( the)?( terms of the)? (3|three) clause bsd licen[cs]e
bsd-2-clause     grant    licensed under( the)?( simplified| freebsd)( bsd)? licen[cs]e
bsd-3-clause     grant    licensed under( the)?( new| modified| revised) bsd licen[cs]e
bsd              grant    licensed under( the)?( terms of the)? bsd( style)? licen[cs]e
isc              grant    licensed under( the)?( terms of the)? isc licen[cs]e
mpl-2.0          grant    licensed under( the)?( terms of the)? (mozilla public license|mpl)( version| v)? ?2( 0)?
mpl              grant    licensed under( the)?( terms of the)? (mozilla public license|mpl)
epl              grant    licensed under( the)?( terms of the)? eclipse public license( version| v)?( [12] 0)?
cddl-1.0         grant    licensed under( the)?( terms of the)? (common development and distribution license|cddl)( version| v)?( 1 [01])?
eupl             grant    licensed under( the)?( terms of the)? (european union public licen[cs]e|eupl)( version| v)?( 1 [012])?
bsl-1.0          grant    licensed under( the)? boost software license( version| v)?( 1 0)?
zlib             grant    licensed under( the)? zlib( libpng)? licen[cs]e
wtfpl            grant    licensed under( the)? wtfpl
unlicense        grant    licensed under( the)? unlicense
artistic         grant    licensed under( the)?( terms of the)? artistic license( version)?( [12] 0)?
cc0-1.0          grant    licensed under( a| the)?( creative commons)? cc0( 1 0)?( universal)?
cc-by-nc-sa-4.0  grant    licensed under( a| the)?( creative commons)? (cc )?by nc sa 4 0
cc-by-nc-sa      grant    licensed under( a| the)?( creative commons)? (cc )?by nc sa( [123] [05])?
cc-by-nc-nd-4.0  grant    licensed under( a| the)?( creative commons)? (cc )?by nc nd 4 0
cc-by-nc-nd      grant    licensed under( a| the)?( creative commons)? (cc )?by nc nd( [123] [05])?
cc-by-nc-4.0     grant    licensed under( a| the)?( creative commons)? (cc )?by nc 4 0
cc-by-nc         grant    licensed under( a| the)?( creative commons)? (cc )?by nc( [123] [05])?
cc-by-sa-4.0     grant    licensed under( a| the)?( creative commons)? (cc )?by sa 4 0
cc-by-sa         grant    licensed under( a| the)?( creative commons)? (cc )?by sa( [123] [05])?
cc-by-nd-4.0     grant    licensed under( a| the)?( creative commons)? (cc )?by nd 4 0
cc-by-nd         grant    licensed under( a| the)?( creative commons)? (cc )?by nd( [123] [05])?
cc-by-4.0        grant    licensed under( a| the)?( creative commons)? (cc )?by 4 0
cc-by-nc-sa      grant    licensed under( a| the)? creative commons attribution non ?commercial share ?alike( [1234] [05])?( international| unported)?( licen[cs]e)?
cc-by-nc-nd      grant    licensed under( a| the)? creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1234] [05])?( international| unported)?( licen[cs]e)?
cc-by-nc         grant    licensed under( a| the)? creative commons attribution non ?commercial( [1234] [05])?( international| unported)?( licen[cs]e)?
cc-by-sa         grant    licensed under( a| the)? creative commons attribution share ?alike( [1234] [05])?( international| unported)?( licen[cs]e)?
cc-by-nd         grant    licensed under( a| the)? creative commons attribution no ?deriv(ative)?s?( works)?( [1234] [05])?( international| unported)?( licen[cs]e)?
cc-by            grant    licensed under( a| the)? creative commons attribution( [1234] [05])?( international| unported)?( licen[cs]e)?
proprietary      grant    licensed under( a| the)?( commercial| proprietary) licen[cs]e
mit              grant    released under( the)?( terms of the)? mit( x11| expat)?( style)?( licen[cs]e)?
apache-2.0       grant    released under( the)?( terms of the)? apache( software)? license( version| v)? ?2( 0)?
apache           grant    released under( the)?( terms of the)? apache( software)? license
gpl-2.0          grant    released under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)( version| v)? ?2( 0)?
gpl-3.0          grant    released under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)( version| v)? ?3( 0)?
gpl              grant    released under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)
lgpl             grant    released under( the)?( terms of the)? (gnu (lesser|library) general public license|gnu lgpl|lgpl)( version| v)?( 2 [01]| 3( 0)?)?
bsd              grant    released under( the)?( terms of the)?( (2|3|two|three) clause| new| modified| simplified)? bsd( style)? licen[cs]e
mpl              grant    released under( the)?( terms of the)? (mozilla public license|mpl)( version| v)?( [12] [01])?
cc0-1.0          grant    released under( the)?( creative commons)? cc0( 1 0)?
cc-by-sa         grant    released under( a| the)?( creative commons)? cc by sa( [1234] [05])?
cc-by-nc         grant    released under( a| the)?( creative commons)? cc by nc( [1234] [05])?
cc-by-4.0        grant    released under( a| the)?( creative commons)? cc by 4 0
public-domain    grant    released (in|into|to) the public domain
gpl-2.0          grant    distributed under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)( version| v)? ?2( 0)?
gpl-3.0          grant    distributed under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)( version| v)? ?3( 0)?
gpl              grant    distributed under( the)?( terms of the)? (gnu general public license|gnu gpl|gpl)
lgpl             grant    distributed under( the)?( terms of the)? (gnu (lesser|library) general public license|gnu lgpl|lgpl)( version| v)?( 2 [01]| 3( 0)?)?
mit              grant    distributed under( the)?( terms of the)? mit( x11| expat)?( style)? licen[cs]e
apache           grant    distributed under( the)?( terms of the)? apache( software)? license( version 2 0)?
bsd              grant    distributed under( the)?( terms of the)?( (2|3|two|three) clause| new| modified| simplified)? bsd( style)? licen[cs]e
bsl-1.0          grant    distributed under( the)? boost software license( version 1 0)?
cc-by            grant    distributed under( a| the)? creative commons attribution( [1234] [05])?( licen[cs]e)?
gpl              grant    redistribute it and or modify it under the terms of the gnu general public license( as published by the free software foundation)?
lgpl             grant    redistribute it and or modify it under the terms of the gnu (lesser|library) general public license( as published by the free software foundation)?
agpl             grant    redistribute it and or modify it under the terms of the gnu affero general public license( as published by the free software foundation)?
perl             grant    redistribute it and or modify it under the same terms as perl( itself)?

apache-2.0       url      apache org licenses license 2 0( html| txt)?
apache-1.1       url      apache org licenses license 1 1( html| txt)?
gpl-2.0          url      gnu org licenses( old licenses)? gpl 2 0( html| txt)?
gpl-3.0          url      gnu org licenses gpl 3 0( html| txt)?
gpl              url      gnu org (licenses|copyleft)( old licenses)? gpl( html| txt)?
lgpl-2.1         url      gnu org licenses( old licenses)? lgpl 2 1( html| txt)?
lgpl-3.0         url      gnu org licenses lgpl 3 0( html| txt)?
lgpl             url      gnu org (licenses|copyleft)( old licenses)? (lgpl|lesser)( html| txt)?
agpl-3.0         url      gnu org licenses agpl( 3 0)?( html| txt)?
gfdl-1.3         url      gnu org licenses (fdl|fdl 1 3)( html| txt)?
mit              url      opensource org licenses mit( license)?( php| html)?
bsd-2-clause     url      opensource org licenses bsd 2 clause
bsd-3-clause     url      opensource org licenses bsd 3 clause
bsd              url      opensource org licenses bsd license( php)?
isc              url      opensource org licenses isc( license)?( php| txt)?
artistic-2.0     url      opensource org licenses artistic license 2 0( php)?
apache-2.0       url      opensource org licenses apache 2 0
mpl-2.0          url      mozilla org mpl 2 0( txt)?
mpl-1.1          url      mozilla org mpl( mpl)?( 1 1)?( html| txt)?
epl-1.0          url      eclipse org legal epl v10( html)?
epl-2.0          url      eclipse org (legal|org documents) epl( v)? ?2 0( html| txt)?
bsl-1.0          url      boost org license 1 0 txt
unlicense        url      unlicense org
wtfpl            url      wtfpl net( about| txt copying)?
ofl-1.1          url      scripts sil org ofl
php-3.01         url      php net license 3 01 txt
cc0-1.0          url      creativecommons org publicdomain zero 1 0
public-domain    url      creativecommons org publicdomain mark 1 0
public-domain    url      creativecommons org licenses publicdomain
cc-by-nc-sa-4.0  url      creativecommons org licenses by nc sa 4 0
cc-by-nc-sa      url      creativecommons org licenses by nc sa [123] [05]
cc-by-nc-nd-4.0  url      creativecommons org licenses by nc nd 4 0
cc-by-nc-nd      url      creativecommons org licenses by (nc nd|nd nc) [123] [05]
cc-by-nc-4.0     url      creativecommons org licenses by nc 4 0
cc-by-nc         url      creativecommons org licenses by nc [123] [05]
cc-by-sa-4.0     url      creativecommons org licenses by sa 4 0
cc-by-sa         url      creativecommons org licenses by sa [123] [05]
cc-by-nd-4.0     url      creativecommons org licenses by nd 4 0
cc-by-nd         url      creativecommons org licenses by nd [123] [05]
cc-by-4.0        url      creativecommons org licenses by 4 0
cc-by-3.0        url      creativecommons org licenses by 3 0
cc-by            url      creativecommons org licenses by [12] [05]
odbl-1.0         url      opendatacommons org licenses odbl( 1 0)?
odc-by-1.0       url      opendatacommons org licenses by( 1 0)?
pddl-1.0         url      opendatacommons org licenses pddl( 1 0)?

gpl-1.0          name     gnu general public license( version| v)? ?1( 0)?
gpl-2.0-or-later name     gnu general public license( version| v)? ?2( 0)? or( at your option)?( any)? later( version)?
gpl-2.0          name     gnu general public license( version| v)? ?2( 0)?
gpl-3.0-or-later name     gnu general public license( version| v)? ?3( 0)? or( at your option)?( any)? later( version)?
gpl-3.0          name     gnu general public license( version| v)? ?3( 0)?
lgpl-2.1         name     gnu lesser general public license( version| v)? ?2 1
lgpl-3.0         name     gnu lesser general public license( version| v)? ?3( 0)?
lgpl             name     gnu (lesser|library) general public license
agpl-3.0         name     gnu affero general public license( version| v)? ?3( 0)?
agpl             name     gnu affero general public license
gfdl             name     gnu free documentation license( version 1 [123])?
apache-2.0       name     apache( software)? license( version| v)? ?2( 0)?
apache-1.1       name     apache( software)? license( version| v)? 1 1
apache-1.0       name     apache( software)? license( version| v)? 1 0
mit              name     mit( x11| expat)?( style)?( open source)? licen[cs]e
bsd-2-clause     name     bsd (2|two) clause( licen[cs]e)?
bsd-3-clause     name     bsd (3|three) clause( licen[cs]e)?
bsd-4-clause     name     bsd (4|four) clause( licen[cs]e)?
bsd              name     bsd( style)? licen[cs]e
isc              name     isc licen[cs]e
mpl-2.0          name     mozilla public license( version| v)? ?2( 0)?
mpl-1.1          name     mozilla public license( version| v)? ?1 1
mpl              name     mozilla public license
epl-2.0          name     eclipse public license( version| v)? ?2( 0)?
epl              name     eclipse public license
cddl-1.0         name     common development and distribution license
cpl-1.0          name     common public license( version)?( 1 0)?
eupl             name     european union public licen[cs]e
bsl-1.0          name     boost software license
busl-1.1         name     business source license( 1 1)?
sspl-1.0         name     server side public license
elastic-2.0      name     elastic license( 2 0)?
zlib             name     zlib( libpng)? licen[cs]e
wtfpl            name     do what the fuck you want to public license
artistic         name     artistic license( [12] 0)?
psf-2.0          name     python software foundation license
php-3.01         name     php license( version)?( 3 01)?
ofl-1.1          name     sil open font license
ms-pl            name     microsoft public license
ms-rl            name     microsoft reciprocal license
ogl-uk-3.0       name     open government licen[cs]e( v)?( ?3 0)?
odbl-1.0         name     open database license
cc0-1.0          name     cc0( 1 0)?( universal)?
cc-by-nc-sa-4.0  name     cc by nc sa 4 0
cc-by-nc-sa      name     cc by nc sa( [123] [05])?
cc-by-nc-nd-4.0  name     cc by nc nd 4 0
cc-by-nc-nd      name     cc by nc nd( [123] [05])?
cc-by-nc-4.0     name     cc by nc 4 0
cc-by-nc         name     cc by nc( [123] [05])?
cc-by-sa-4.0     name     cc by sa 4 0
cc-by-sa         name     cc by sa( [123] [05])?
cc-by-nd-4.0     name     cc by nd 4 0
cc-by-nd         name     cc by nd( [123] [05])?
cc-by-4.0        name     cc by 4 0
cc-by-3.0        name     cc by 3 0
cc-by-nc-sa      name     creative commons attribution non ?commercial share ?alike
cc-by-nc-nd      name     creative commons attribution non ?commercial no ?deriv(ative)?s?
cc-by-nc         name     creative commons attribution non ?commercial
cc-by-sa         name     creative commons attribution share ?alike
cc-by-nd         name     creative commons attribution no ?deriv(ative)?s?
cc-by            name     creative commons attribution

gpl              mention  gpl ?v?[123]?
lgpl             mention  lgpl ?v?[23]?
agpl             mention  agpl ?v?3?
gfdl             mention  gfdl
mpl              mention  mpl 2 0
cddl-1.0         mention  cddl
copyleft         mention  copyleft
creative-commons mention  creative commons( licen[cs]e)?
open-source      mention  open source (licen[cs]e|initiative)
proprietary      mention  proprietary (licen[cs]e|software)
proprietary      mention  commercial licen[cs]e
"""


class Rule(NamedTuple):
    number: int
    label: str
    kind: str
    rank: int
    confidence: float
    base: bool
    keyword: str
    pattern: str


def read_rules(text: str = RULES, base: dict[str, str] | None = None) -> list[Rule]:
    """The base phrases, as mentions, then the rules of a text in its order. Raises ValueError for a rule that could not be matched."""
    lines = [(label, "mention", phrase, True) for phrase, label in (BASE if base is None else base).items()]
    lines += [(*line.split(None, 2), False) for line in text.splitlines() if line.strip()]
    out = []
    for i, (label, kind, body, is_base) in enumerate(lines):
        body = body.strip()
        head = re.match(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+(?=$|[ (])", body)
        if kind not in KINDS or not head or body.startswith(f"{head.group()}|"):
            raise ValueError(f"not a rule: {label} {kind} {body}")
        re.compile(body)
        out.append(Rule(i, label, kind, list(KINDS).index(kind), KINDS[kind], is_base, head.group(), f"^(?:{body}) "))
    return out
