"""Ordered signature rules for license texts, over lower-case words that are
separated by one space (punctuation is gone: ``apache-2.0`` reads ``apache 2 0``).

A line ``@ keyword|keyword`` opens the rules that can match only in a text holding
one of those words or phrases; a rule is ``level label: pattern``. Levels, the strongest first:
1 identifier tags, 2 sentences of a grant or license text, 3 addresses, 4 names
with their version, 5 names, 6 mentions. Patterns match whole words; they use
only what all regular-expression engines share.
"""

from __future__ import annotations

from typing import NamedTuple

RULES_TEXT = """
@ spdx
1 mit: spdx license identifier mit
1 mit-0: spdx license identifier mit 0
1 apache-2.0: spdx license identifier apache 2 0
1 apache-1.1: spdx license identifier apache 1 1
1 gpl-1.0: spdx license identifier gpl 1 0(?: only| or later)?
1 gpl-2.0: spdx license identifier gpl 2 0(?: only| or later)?
1 gpl-3.0: spdx license identifier gpl 3 0(?: only| or later)?
1 lgpl-2.0: spdx license identifier lgpl 2 0(?: only| or later)?
1 lgpl-2.1: spdx license identifier lgpl 2 1(?: only| or later)?
1 lgpl-3.0: spdx license identifier lgpl 3 0(?: only| or later)?
1 agpl-3.0: spdx license identifier agpl 3 0(?: only| or later)?
1 gfdl-1.3: spdx license identifier gfdl 1 3(?: only| or later)?
1 mpl-1.1: spdx license identifier mpl 1 1
1 mpl-2.0: spdx license identifier mpl 2 0(?: no copyleft exception)?
1 bsd-1-clause: spdx license identifier bsd 1 clause
1 bsd-2-clause: spdx license identifier bsd 2 clause(?: patent| views)?
1 bsd-3-clause: spdx license identifier bsd 3 clause(?: clear| lbnl)?
1 bsd-4-clause: spdx license identifier bsd 4 clause(?: uc)?
1 0bsd: spdx license identifier 0bsd
1 isc: spdx license identifier isc
1 zlib: spdx license identifier zlib
1 unlicense: spdx license identifier unlicense
1 wtfpl: spdx license identifier wtfpl
1 cc0-1.0: spdx license identifier cc0 1 0
1 cc-by-3.0: spdx license identifier cc by 3 0
1 cc-by-4.0: spdx license identifier cc by 4 0
1 cc-by-sa-3.0: spdx license identifier cc by sa 3 0
1 cc-by-sa-4.0: spdx license identifier cc by sa 4 0
1 cc-by-nd-4.0: spdx license identifier cc by nd 4 0
1 cc-by-nc-4.0: spdx license identifier cc by nc 4 0
1 cc-by-nc-sa-4.0: spdx license identifier cc by nc sa 4 0
1 cc-by-nc-nd-4.0: spdx license identifier cc by nc nd 4 0
1 epl-1.0: spdx license identifier epl 1 0
1 epl-2.0: spdx license identifier epl 2 0
1 eupl-1.1: spdx license identifier eupl 1 1
1 eupl-1.2: spdx license identifier eupl 1 2
1 cddl-1.0: spdx license identifier cddl 1 0
1 cpl-1.0: spdx license identifier cpl 1 0
1 bsl-1.0: spdx license identifier bsl 1 0
1 busl-1.1: spdx license identifier busl 1 1
1 sspl-1.0: spdx license identifier sspl 1 0
1 elastic-2.0: spdx license identifier elastic 2 0
1 artistic-2.0: spdx license identifier artistic 2 0
1 ofl-1.1: spdx license identifier ofl 1 1
1 odbl-1.0: spdx license identifier odbl 1 0
1 ms-pl: spdx license identifier ms pl
1 ms-rl: spdx license identifier ms rl
1 ncsa: spdx license identifier ncsa
1 osl-3.0: spdx license identifier osl 3 0
1 afl-3.0: spdx license identifier afl 3 0
1 ecl-2.0: spdx license identifier ecl 2 0
1 upl-1.0: spdx license identifier upl 1 0
1 postgresql: spdx license identifier postgresql
1 python-2.0: spdx license identifier (?:python 2 0|psf 2 0)
1 mulanpsl-2.0: spdx license identifier mulanpsl 2 0
1 blueoak-1.0.0: spdx license identifier blueoak 1 0 0
1 x11: spdx license identifier x11
1 vim: spdx license identifier vim
@ apache
2 apache-2.0: licensed under the apache license version 2 0 the license(?: you may not use this file except in compliance with the license)?
2 apache-2.0: licensed to the apache software foundation(?: asf)? under one or more contributor license agreements
2 apache-1.1: this product includes software developed by the apache (?:software foundation|group)(?: http www apache org)?
3 apache-2.0: (?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?
3 apache-1.1: (?:https? )?(?:www )?apache org licenses license 1 1(?: txt| html)?
4 apache-2.0: (?:the )?apache(?: software)? license(?: version)? (?:v )?(?:2 0|2|v2|v2 0)
4 apache-2.0: apache (?:2 0|v2 0|v2|2)(?: open source)?(?: software)?(?: license)?
4 apache-1.1: (?:the )?apache(?: software)? license(?: version)? (?:v )?(?:1 1|v1 1)
4 apache-1.0: (?:the )?apache(?: software)? license(?: version)? (?:v )?(?:1 0|v1 0)
5 apache: (?:the )?apache(?: software)? licen[cs]e
6 apache: (?:licensed|released|distributed|available) under(?: the)? apache
6 apache: apache licensed
@ asl
4 apache-2.0: asl (?:v )?2 0
@ general public
2 gpl-1.0: under the terms of the gnu general public license as published by the free software foundation either version 1(?: of the license)?(?: or at your option any later version)?
2 gpl-2.0: under the terms of the gnu general public license as published by the free software foundation either version 2(?: of the license)?(?: or at your option any later version)?
2 gpl-3.0: under the terms of the gnu general public license as published by the free software foundation either version 3(?: of the license)?(?: or at your option any later version)?
2 gpl-2.0: under the terms(?: and conditions)? of the gnu general public license version 2(?: as published by the free software foundation)?
2 gpl-3.0: under the terms(?: and conditions)? of the gnu general public license version 3(?: as published by the free software foundation)?
2 lgpl-2.0: under the terms of the gnu (?:library|lesser) general public license as published by the free software foundation either version 2(?: of the license)?(?: or at your option any later version)?
2 lgpl-2.1: under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1(?: of the license)?(?: or at your option any later version)?
2 lgpl-3.0: under the terms of the gnu lesser general public license as published by the free software foundation either version 3(?: of the license)?(?: or at your option any later version)?
2 agpl-3.0: under the terms of the gnu affero general public license as published by the free software foundation either version 3(?: of the license)?(?: or at your option any later version)?
2 gpl: you should have received a copy of the gnu general public license(?: along with this (?:program|file|library|package))?
2 lgpl: you should have received a copy of the gnu (?:lesser|library) general public license(?: along with this (?:program|file|library|package))?
2 agpl: you should have received a copy of the gnu affero general public license(?: along with this (?:program|file|library|package))?
4 gpl-1.0: gnu general public license(?: gpl)? (?:version|v) 1(?: 0)?(?: or later)?
4 gpl-2.0: gnu general public license(?: gpl)? (?:(?:version |v )?2|v2)(?: 0)?(?: or later)?
4 gpl-3.0: gnu general public license(?: gpl)? (?:(?:version |v )?3|v3)(?: 0)?(?: or later)?
4 lgpl-2.0: gnu (?:library|lesser) general public license(?: lgpl)? (?:version |v )?2(?: 0)?(?: or later)?
4 lgpl-2.1: gnu lesser general public license(?: lgpl)? (?:version |v )?2 1(?: or later)?
4 lgpl-3.0: gnu lesser general public license(?: lgpl)? (?:(?:version |v )?3|v3)(?: 0)?(?: or later)?
4 agpl-3.0: (?:gnu )?affero general public license(?: agpl)? (?:(?:version |v )?3|v3)(?: 0)?(?: or later)?
4 agpl-1.0: affero general public license(?: version| v)? 1(?: 0)?
5 gpl: gnu general public license
5 lgpl: (?:gnu )?(?:lesser|library) general public license
5 agpl: (?:gnu )?affero general public license
6 gpl: general public license
@ gpl|lgpl|agpl|gplv2|gplv3|lgplv2|lgplv3|agplv3
4 gpl-1.0: (?:gnu )?gpl (?:version |v )?1 0(?: or later)?
4 gpl-2.0: (?:gnu )?gpl (?:version |v )?2(?: 0)?(?: or later| only)?
4 gpl-2.0: (?:gnu )?gplv2(?: 0)?(?: or later)?
4 gpl-3.0: (?:gnu )?gpl (?:version |v )?3(?: 0)?(?: or later| only)?
4 gpl-3.0: (?:gnu )?gplv3(?: 0)?(?: or later)?
4 lgpl-2.0: (?:gnu )?lgpl (?:version |v )?2(?: 0)?(?: or later| only)?
4 lgpl-2.1: (?:gnu )?(?:lgpl (?:version |v )?2 1|lgplv2 1)(?: or later| only)?
4 lgpl-3.0: (?:gnu )?(?:lgpl (?:version |v )?3|lgplv3)(?: 0)?(?: or later| only)?
4 agpl-3.0: (?:gnu )?(?:agpl (?:version |v )?3|agplv3)(?: 0)?(?: or later| only)?
5 gpl: (?:gnu )?gpl license
5 lgpl: (?:gnu )?lgpl license
5 agpl: (?:gnu )?agpl license
6 gpl: (?:licensed|released|distributed|available) under(?: the)?(?: gnu)? gpl
6 lgpl: (?:licensed|released|distributed|available) under(?: the)?(?: gnu)? lgpl
6 agpl: (?:licensed|released|distributed|available) under(?: the)?(?: gnu)? agpl
6 gpl: gnu gpl
6 lgpl: gnu lgpl
6 agpl: gnu agpl
@ gnu org
3 gpl-2.0: (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
3 gpl-3.0: (?:www )?gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
3 gpl: (?:www )?gnu org (?:licenses|copyleft) gpl(?: en)?(?: html| txt)?
3 lgpl-2.1: (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
3 lgpl-3.0: (?:www )?gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?
3 agpl-3.0: (?:www )?gnu org licenses agpl 3 0(?: en)?(?: html| txt)?
3 gfdl: (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 3)?(?: html| txt)?
3 gpl: (?:www )?gnu org licenses
@ gnu free documentation
4 gfdl-1.1: gnu free documentation license(?: gfdl)? version 1 1(?: or any later version)?
4 gfdl-1.2: gnu free documentation license(?: gfdl)? version 1 2(?: or any later version)?
4 gfdl-1.3: gnu free documentation license(?: gfdl)? version 1 3(?: or any later version)?
5 gfdl: gnu free documentation license
@ mit
2 mit: licensed under the mit license see license(?: [^ ]+){0,3} for (?:details|license information|more information)
3 mit: (?:https? )?(?:www )?opensource org licenses mit(?: license)?(?: php| html)?
3 mit: (?:https? )?choosealicense com licenses mit
3 mit: (?:https? )?mit license org
4 mit-0: mit no attribution(?: license)?
4 mit-0: mit 0 license
4 x11: (?:mit x11|x11 mit|mit x consortium) license
5 mit: (?:the )?mit licen[cs]e
6 mit: (?:licensed|released|distributed|available) under(?: the)?(?: terms of the)? mit
6 mit: mit licensed
@ permission is hereby granted
2 mit: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
2 bsl-1.0: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
2 ofl-1.1: permission is hereby granted free of charge to any person obtaining a copy of the font software
2 mit-0: permission is hereby granted free of charge to any person obtaining a copy of this software(?: [^ ]+){0,12} without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is
@ above copyright notice
2 mit: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
2 isc: provided that the above copyright notice and this permission notice appear in all copies
2 bsd-2-clause: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 bsd-2-clause: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
@ permission to use
2 postgresql: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
2 isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
2 0bsd: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
2 hpnd: permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: without fee)? is hereby granted(?: without fee)? provided that
@ redistribution and use
2 bsd: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
2 bsd: redistribution and use in source and binary forms with or without modification are permitted
@ neither the name
2 bsd-3-clause: neither the name of(?: the)?(?: [^ ]+){1,12} nor the names of (?:its|their|other|any) contributors may be used to endorse or promote products derived from this software
@ advertising materials
2 bsd-4-clause: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
@ bsd|0bsd
3 bsd-2-clause: (?:www )?opensource org licenses bsd 2 clause
3 bsd-3-clause: (?:www )?opensource org licenses bsd 3 clause
3 bsd: (?:www )?opensource org licenses bsd license(?: php| html)?
4 0bsd: (?:0bsd|bsd zero clause|zero clause bsd)(?: license)?
4 bsd-2-clause: (?:simplified|freebsd) bsd license
4 bsd-2-clause: (?:bsd (?:2|two) clause|(?:2|two) clause bsd)(?: license)?
4 bsd-3-clause: (?:new|modified|revised) bsd license
4 bsd-3-clause: (?:bsd (?:3|three) clause|(?:3|three) clause bsd)(?: license)?
4 bsd-4-clause: (?:original|old) bsd license
4 bsd-4-clause: (?:bsd (?:4|four) clause|(?:4|four) clause bsd)(?: license)?
5 bsd: bsd(?: style| type)? licen[cs]e
6 bsd: (?:licensed|released|distributed|available) under(?: the)?(?: a)? bsd
6 bsd: bsd licensed
@ isc
4 isc: (?:the )?isc licen[cs]e
3 isc: (?:www )?opensource org licenses isc(?: license)?
6 isc: (?:licensed|released|distributed|available) under(?: the)? isc
@ mozilla
2 mpl-2.0: this source code form is subject to the terms of the mozilla public license v 2 0
2 mpl-1.1: the contents of this file are subject to the mozilla public license version 1 1
4 mpl-1.0: mozilla public license(?: mpl)?(?: version| v)? 1 0
4 mpl-1.1: mozilla public license(?: mpl)?(?: version| v)? 1 1
4 mpl-2.0: mozilla public license(?: mpl)?(?: version| v)? (?:2 0|v2 0|2)
3 mpl-2.0: (?:www )?mozilla org mpl 2 0
3 mpl-1.1: (?:www )?mozilla org mpl mpl 1 1(?: html| txt)?
3 mpl: (?:www )?mozilla org mpl
5 mpl: mozilla public license
@ mpl
4 mpl-1.1: mpl (?:v )?(?:1 1|v1 1)
4 mpl-2.0: mpl (?:v )?(?:2 0|v2 0|v2)
6 mpl: (?:licensed|released|distributed|available) under(?: the)? mpl
@ creativecommons
3 cc0-1.0: creativecommons org publicdomain zero 1 0(?: legalcode| deed)?
3 cc-pdm-1.0: creativecommons org publicdomain mark 1 0
3 cc-by-2.0: creativecommons org licenses by 2 0
3 cc-by-3.0: creativecommons org licenses by 3 0
3 cc-by-4.0: creativecommons org licenses by 4 0
3 cc-by-sa-2.0: creativecommons org licenses by sa 2 0
3 cc-by-sa-3.0: creativecommons org licenses by sa 3 0
3 cc-by-sa-4.0: creativecommons org licenses by sa 4 0
3 cc-by-nd-3.0: creativecommons org licenses by nd 3 0
3 cc-by-nd-4.0: creativecommons org licenses by nd 4 0
3 cc-by-nc-3.0: creativecommons org licenses by nc 3 0
3 cc-by-nc-4.0: creativecommons org licenses by nc 4 0
3 cc-by-nc-sa-3.0: creativecommons org licenses by nc sa 3 0
3 cc-by-nc-sa-4.0: creativecommons org licenses by nc sa 4 0
3 cc-by-nc-nd-3.0: creativecommons org licenses by nc nd 3 0
3 cc-by-nc-nd-4.0: creativecommons org licenses by nc nd 4 0
@ creative commons
2 cc-by: this work is licensed under a creative commons attribution [^ ]+(?: [^ ]+){0,3} license
4 cc0-1.0: creative commons (?:zero|cc0)(?: v)?(?: 1 0)?(?: universal)?
4 cc-by-4.0: creative commons attribution 4 0(?: international)?(?: public)?(?: license)?
4 cc-by-3.0: creative commons attribution 3 0(?: unported)?(?: license)?
4 cc-by-sa-4.0: creative commons attribution (?:share alike|sharealike) 4 0(?: international)?(?: public)?(?: license)?
4 cc-by-sa-3.0: creative commons attribution (?:share alike|sharealike) 3 0(?: unported)?(?: license)?
4 cc-by-nd-4.0: creative commons attribution (?:no derivatives?|no derivative works|no derivs|noderivatives|noderivs) 4 0(?: international)?(?: license)?
4 cc-by-nc-4.0: creative commons attribution (?:non commercial|noncommercial) 4 0(?: international)?(?: public)?(?: license)?
4 cc-by-nc-sa-4.0: creative commons attribution (?:non commercial|noncommercial) (?:share alike|sharealike) 4 0(?: international)?(?: public)?(?: license)?
4 cc-by-nc-nd-4.0: creative commons attribution (?:non commercial|noncommercial) (?:no derivatives?|no derivative works|no derivs|noderivatives|noderivs) 4 0(?: international)?(?: license)?
5 cc-by-sa: creative commons attribution (?:share alike|sharealike)(?: license)?
5 cc-by-nc: creative commons attribution (?:non commercial|noncommercial)(?: license)?
5 cc-by: creative commons attribution(?: license)?
6 cc: creative commons(?: licen[cs]ed?)?
@ cc by
4 cc-by-1.0: cc by 1 0
4 cc-by-2.0: cc by 2 0
4 cc-by-2.5: cc by 2 5
4 cc-by-3.0: cc by 3 0(?: [^ ]{2})?
4 cc-by-4.0: cc by 4 0
4 cc-by-sa-2.0: cc by sa 2 0
4 cc-by-sa-2.5: cc by sa 2 5
4 cc-by-sa-3.0: cc by sa 3 0
4 cc-by-sa-4.0: cc by sa 4 0
4 cc-by-nd-3.0: cc by nd 3 0
4 cc-by-nd-4.0: cc by nd 4 0
4 cc-by-nc-2.0: cc by nc 2 0
4 cc-by-nc-3.0: cc by nc 3 0
4 cc-by-nc-4.0: cc by nc 4 0
4 cc-by-nc-sa-2.0: cc by nc sa 2 0
4 cc-by-nc-sa-3.0: cc by nc sa 3 0
4 cc-by-nc-sa-4.0: cc by nc sa 4 0
4 cc-by-nc-nd-3.0: cc by nc nd 3 0
4 cc-by-nc-nd-4.0: cc by nc nd 4 0
5 cc-by-nc-sa: cc by nc sa
5 cc-by-nc-nd: cc by nc nd
5 cc-by-sa: cc by sa
5 cc-by-nd: cc by nd
5 cc-by-nc: cc by nc
5 cc-by: cc by
@ cc0
4 cc0-1.0: cc0 (?:v )?1 0(?: universal)?
5 cc0-1.0: cc0(?: public domain)?(?: dedication| license| waiver)?
@ domain
2 unlicense: this is free and unencumbered software released into the public domain
5 public-domain: (?:released|placed|dedicated|donated) (?:in|into|to) the public domain
5 public-domain: public domain dedication
6 public-domain: (?:is|are) (?:in|within) the public domain
@ anyone is free
2 unlicense: anyone is free to copy modify publish use compile sell or distribute this software
@ unlicense
3 unlicense: (?:www )?unlicense org
5 unlicense: the unlicense
6 unlicense: (?:licensed|released|distributed|available) under(?: the)? unlicense
@ wtfpl
5 wtfpl: wtfpl(?: license)?(?: version 2)?
@ fuck you want
4 wtfpl: do what the fuck you want to public license(?: version 2)?
@ eclipse
4 epl-1.0: eclipse public license(?: epl)?(?: version| v)? (?:1 0|v1 0|v10)
4 epl-2.0: eclipse public license(?: epl)?(?: version| v)? (?:2 0|v2 0|v20)
3 epl-1.0: (?:www )?eclipse org legal epl v10(?: html)?
3 epl-2.0: (?:www )?eclipse org legal epl (?:2 0|v20)(?: html)?
4 edl-1.0: eclipse distribution license(?: version| v)? 1 0
5 epl: eclipse public license
@ epl
4 epl-1.0: epl (?:v )?(?:1 0|v1 0)
4 epl-2.0: epl (?:v )?(?:2 0|v2 0)
@ european union public
4 eupl-1.1: european union public licen[cs]e(?: eupl)?(?: version| v)? (?:1 1|v1 1)
4 eupl-1.2: european union public licen[cs]e(?: eupl)?(?: version| v)? (?:1 2|v1 2)
5 eupl: european union public licen[cs]e
@ common development and distribution
4 cddl-1.0: common development and distribution license(?: cddl)?(?: version| v)? 1 0
4 cddl-1.1: common development and distribution license(?: cddl)?(?: version| v)? 1 1
5 cddl: common development and distribution license
@ boost software
2 bsl-1.0: distributed under the boost software license version 1 0
4 bsl-1.0: boost software license(?: version| v)? 1 0
5 bsl-1.0: boost software license
@ zlib
4 zlib: zlib libpng license
5 zlib: zlib licen[cs]e
@ misrepresented
2 zlib: the origin of this software must not be misrepresented you must not claim that you wrote the original software
@ artistic
4 artistic-1.0: artistic license(?: version| v)? 1 0
4 artistic-2.0: artistic license(?: version| v)? 2 0
5 artistic: (?:the )?artistic license
@ perl itself
6 artistic: same terms as perl itself
@ font
4 ofl-1.1: (?:sil )?open font license(?: ofl)?(?: version| v)? 1 1
5 ofl: (?:sil )?open font license
@ scripts sil org
3 ofl-1.1: scripts sil org ofl
@ database license
4 odbl-1.0: open database license(?: odbl)?(?: version| v)? 1 0
5 odbl: open database license
@ commons
4 odc-by-1.0: open data commons attribution license(?: version| v)?(?: 1 0)?
4 pddl-1.0: open data commons public domain dedication and license
5 odc: open data commons
@ microsoft
5 ms-pl: microsoft public license(?: ms pl)?
5 ms-rl: microsoft reciprocal license(?: ms rl)?
@ python software foundation
4 python-2.0: python software foundation license version 2
5 psf: python software foundation license
@ academic free
4 afl-3.0: academic free license(?: version| v)? 3 0
5 afl: academic free license
@ software license
4 osl-3.0: open software license(?: version| v)? 3 0
5 osl: open software license
@ business source
4 busl-1.1: business source license(?: version| v)? 1 1
5 busl: business source license
@ server side public
4 sspl-1.0: server side public license(?: version| v)? 1
@ elastic license
4 elastic-2.0: elastic license(?: version| v)? (?:2 0|2)
5 elastic: elastic license
@ universal permissive
4 upl-1.0: universal permissive license(?: version| v)?(?: 1 0)?
@ mulan
4 mulanpsl-2.0: mulan (?:psl v2|permissive software license v2)
@ ncsa
4 ncsa: (?:university of illinois )?ncsa open source license
@ rights reserved
6 proprietary: all rights reserved
@ unauthorized copying
2 proprietary: unauthorized copying of this file via any medium is strictly prohibited(?: proprietary and confidential)?
@ proprietary and confidential
4 proprietary: proprietary and confidential
"""


class Rule(NamedTuple):
    rank: int
    level: int
    label: str
    keywords: tuple[str, ...]
    pattern: str


def spaced(text: str) -> str:
    """Words with a space of their own on either side, so that neighbouring
    matches do not share one."""

    return " " + text.replace(" ", "  ") + " "


def read_rules(text: str = RULES_TEXT) -> list[Rule]:
    """The rules in their order."""

    out: list[Rule] = []
    keywords: tuple[str, ...] = ()
    for line in filter(None, map(str.strip, text.splitlines())):
        if line.startswith("@ "):
            keywords = tuple(spaced(k) for k in line[2:].split("|"))
            continue
        head, pattern = line.split(": ", 1)
        level, label = head.split(" ")
        out.append(Rule(len(out), int(level), label, keywords, spaced(pattern)))
    return out
