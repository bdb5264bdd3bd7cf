"""The signature rules of the licence scan, in order of priority.

A rule is "label | keyword | pattern". Patterns are written over normalised text: words in lower case with one
space between (punctuation is gone, so "GPL-3.0+" reads "gpl 3 0"). <n> stands for up to n words of any
kind. The keyword is a word that every match contains; documents without it never run the pattern. Tiers
come in order of priority: identifiers, grants (sentences of the licence texts), names, mentions."""

from __future__ import annotations

#: Machine-readable identifiers (SPDX); the rule for each follows from its words.
IDENTIFIERS = """
0bsd afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 bsd-1-clause bsd-2-clause
bsd-3-clause bsd-4-clause bsl-1.0 busl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0
cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5
cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 ecl-2.0 elastic-2.0 epl-1.0 epl-2.0
eupl-1.1 eupl-1.2 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-3.0 hpnd isc lgpl-2.0 lgpl-2.1 lgpl-3.0 lppl-1.3c mit mit-0 mpl-1.0
mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby
sspl-1.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
"""

#: Sentences that only the licence itself or its standard notice contains.
GRANTS = """
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy
mit | sublicense | to use copy modify merge publish distribute sublicense and or sell copies
mit | permission | the above copyright notice and this permission notice shall be included in all copies
isc | fee | permission to use copy modify and or distribute this software for any purpose with or without fee
hpnd | fee | permission to use copy modify and distribute this software and its documentation for any purpose<3> without fee
bsd-3-clause | endorse | neither the name of<12> nor the names of its contributors may be used to endorse
bsd-3-clause | endorse | the name of<8> may not be used to endorse or promote products
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
bsd-2-clause | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-2-clause | redistributions | redistributions of source code must retain the above copyright notice
bsd-2-clause | redistribution | redistribution and use in source and binary forms with or without modification are permitted
apache-2.0 | apache | licensed under the apache license version 2 0 the license
apache-2.0 | compliance | you may not use this file except in compliance with the license
apache-2.0 | contributor | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
apache-1.1 | apache | the names apache<6> must not be used to endorse or promote products
gpl-2.0 | gnu | redistribute it and or modify it under the terms of the gnu general public license<8> version 2
gpl-3.0 | gnu | redistribute it and or modify it under the terms of the gnu general public license<8> version 3
gpl | gnu | this program is distributed<8> without any warranty<14> see the gnu general public license
gpl | gnu | you should have received a copy of the gnu general public license
gpl | gnu | released under the terms of the gnu general public license
gpl | freedom | the licenses for most software are designed to take away your freedom
gpl-3.0 | copyleft | the gnu general public license is a free copyleft license for software
lgpl-2.1 | lesser | under the terms of the gnu lesser general public license<8> version 2 1
lgpl-3.0 | lesser | under the terms of the gnu lesser general public license<8> version 3
lgpl | lesser | you should have received a copy of the gnu lesser general public license
lgpl-2.0 | library | under the terms of the gnu library general public license
agpl-3.0 | affero | under the terms of the gnu affero general public license<8> version 3
agpl | affero | you should have received a copy of the gnu affero general public license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | mozilla | the contents of this file are subject to the mozilla public license version 1 0
mpl-2.0 | mpl | if a copy of the mpl was not distributed with this file
epl-2.0 | eclipse | made available under the terms of the eclipse public license( v)? 2 0
epl-1.0 | eclipse | made available under the terms of the eclipse public license( v)? 1 0
cddl-1.0 | development | subject to the terms of the common development and distribution license
eupl-1.2 | eupl | licensed under the eupl( version)? 1 2
eupl-1.1 | eupl | licensed under the eupl( version)? 1 1
bsl-1.0 | boost | distributed under the boost software license version 1 0
bsl-1.0 | hereby | permission is hereby granted free of charge to any person or organization obtaining a copy
zlib | origin | the origin of this software must not be misrepresented
zlib | altered | altered source versions must be plainly marked as such
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | fuck | you just do what the fuck you want to
cc0-1.0 | waived | has waived all copyright and related or neighboring rights
cc0-1.0 | cc0 | to the extent possible under law<6> cc0
ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
gfdl-1.3 | documentation | under the terms of the gnu free documentation license version 1 3
gfdl-1.2 | documentation | under the terms of the gnu free documentation license version 1 2
gfdl | documentation | permission is granted to copy distribute and or modify this document<8> gnu free documentation license
artistic-2.0 | artistic | the artistic license 2 0<8> everyone is permitted to copy
artistic-1.0 | package | the intent of this document is to state the conditions under which a package may be copied
lppl-1.3c | latex | conditions of the latex project public license<6> version 1 3
postgresql | documentation | permission to use copy modify and distribute this software and its documentation for any purpose<1> without fee and without a written agreement
python-2.0 | psf | psf hereby grants licensee a nonexclusive royalty free world wide license
openssl | openssl | this product includes software developed by the openssl project
apsl-2.0 | apple | subject to the apple public source license version 2 0
ms-pl | microsoft | this license governs use of the accompanying software<40> microsoft public license
ncsa | deal | permission is hereby granted<12> to deal with the software without restriction
odbl-1.0 | database | this<4> database is made available under the open database license
sspl-1.0 | server | under the terms of the server side public license version 1
busl-1.1 | licensor | licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
upl-1.0 | permissive | the universal permissive license( upl)? version 1 0
cecill-2.1 | cecill | governed by the cecill license under french law
w3c | w3c | this work is being provided by the copyright holders under the following license<20> w3c
afl-3.0 | academic | licensed under the academic free license version 3 0
osl-3.0 | open | licensed under the open software license version 3 0
ecl-2.0 | educational | licensed under the educational community license version 2 0
unicode-dfs-2016 | unicode | permission is hereby granted<16> unicode data files
public-domain | domain | (has been|is hereby|are hereby|is|was) (placed|released|dedicated|put)<2> (in|into|to) the public domain
proprietary | prohibited | unauthorized (copying|reproduction|use|distribution)<12> is strictly prohibited
proprietary | confidential | proprietary and confidential
proprietary | permission | (no part of|may not be reproduced)<20> without<3> (prior|express|written)<2> permission
proprietary | consent | (no part of|may not be reproduced)<20> without<3> (prior|express|written)<2> consent
"""

#: Full names, versions and addresses.
NAMES = """
apache-2.0 | apache | apache( software)? licen[sc]e( version)?( v)? 2( 0)?
apache-2.0 | apache | apache licen[sc]e v2( 0)?
apache-2.0 | apache | (www )?apache org licenses license 2 0
apache-2.0 | apache | apache 2( 0)? licen[sc]ed?
apache-2.0 | asl | asl( version)? 2( 0)?
apache-1.1 | apache | apache( software)? licen[sc]e( version)? 1 1
apache-1.0 | apache | apache( software)? licen[sc]e( version)? 1 0
mit | mit | (the )?mit( x11)? licen[sc]e
mit | mit | licen[sc]ed under( the)? mit
mit | expat | expat licen[sc]e
mit | opensource | (www )?opensource org licenses mit( license)?( php)?
mit | choosealicense | choosealicense com licenses mit
mit-0 | mit | mit no attribution( licen[sc]e)?
x11 | x11 | x11 licen[sc]e
bsd-3-clause | bsd | (3|three) clause bsd( licen[sc]e)?
bsd-3-clause | bsd | bsd (3|three) clause( licen[sc]e)?
bsd-3-clause | bsd | (new|modified|revised) bsd licen[sc]e
bsd-3-clause | opensource | (www )?opensource org licenses bsd 3 clause
bsd-2-clause | bsd | (2|two) clause bsd( licen[sc]e)?
bsd-2-clause | bsd | bsd (2|two) clause( licen[sc]e)?
bsd-2-clause | bsd | (simplified|freebsd) bsd licen[sc]e
bsd-2-clause | opensource | (www )?opensource org licenses bsd 2 clause
bsd-4-clause | bsd | (4 clause|four clause|original|old) bsd( licen[sc]e)?
0bsd | bsd | (zero clause|0 clause) bsd( licen[sc]e)?
isc | isc | isc licen[sc]e
gpl-1.0 | gpl | gpl( version| v)? 1( 0)?
gpl-2.0 | gpl | gpl( version| v)? 2( 0)?( or( any)? later)?
gpl-2.0 | gplv2 | gplv2( or( any)? later)?
gpl-2.0 | gnu | gnu general public licen[sc]e( gpl)?( version| v) 2( 0)?
gpl-2.0 | gnu | gnu gpl( version| v)? 2
gpl-2.0 | gnu | (www )?gnu org licenses( old licenses)? gpl 2 0
gpl-2.0-linking | classpath | gpl<4> (with the )?classpath exception
gpl-3.0 | gpl | gpl( version| v)? 3( 0)?( or( any)? later)?
gpl-3.0 | gplv3 | gplv3( or( any)? later)?
gpl-3.0 | gpl | (gnu )?gpl v3( or( any)? later)?
gpl-2.0 | gpl | (gnu )?gpl v2( or( any)? later)?
gpl-3.0 | gnu | gnu general public licen[sc]e( gpl)?( version| v) 3( 0)?
gpl-3.0 | gnu | gnu gpl( version| v)? 3
gpl-3.0 | gnu | (www )?gnu org licenses gpl 3 0
lgpl-2.0 | lgpl | lgpl( version| v)? 2 0
lgpl-2.0 | library | gnu library general public licen[sc]e
lgpl-2.1 | lgpl | lgpl( version| v)? 2 1( or( any)? later)?
lgpl-2.1 | lgplv2 | lgplv2( 1)?
lgpl-2.1 | lesser | gnu lesser general public licen[sc]e( lgpl)?( version| v) 2 1
lgpl-2.1 | gnu | (www )?gnu org licenses( old licenses)? lgpl 2 1
lgpl-3.0 | lgpl | lgpl( version| v)? 3( 0)?( or( any)? later)?
lgpl-3.0 | lgplv3 | lgplv3
lgpl-3.0 | lgpl | lgpl v3( or( any)? later)?
lgpl-2.1 | lgpl | lgpl v2( 1)?( or( any)? later)?
lgpl-3.0 | lesser | gnu lesser general public licen[sc]e( lgpl)?( version| v) 3( 0)?
lgpl-3.0 | gnu | (www )?gnu org licenses lgpl 3 0
lgpl | lesser | gnu lesser general public licen[sc]e
agpl-3.0 | agpl | agpl( version| v)? 3( 0)?
agpl-3.0 | agplv3 | agplv3
agpl-3.0 | agpl | agpl v3( or( any)? later)?
agpl-3.0 | affero | gnu affero general public licen[sc]e( agpl)?( version| v) 3( 0)?
agpl-3.0 | gnu | (www )?gnu org licenses agpl 3 0
agpl | affero | affero general public licen[sc]e
gfdl-1.3 | gfdl | gfdl( version| v)? 1 3
gfdl-1.2 | gfdl | gfdl( version| v)? 1 2
gfdl | documentation | gnu free documentation licen[sc]e
gfdl | gnu | (www )?gnu org (copyleft|licenses) fdl
mpl-2.0 | mozilla | mozilla public licen[sc]e( version| v)? 2( 0)?
mpl-2.0 | mpl | mpl( version| v)? 2 0
mpl-2.0 | mpl | mpl v2( 0)?
mpl-2.0 | mozilla | (www )?mozilla org (mpl|en us mpl) 2 0
mpl-1.1 | mozilla | mozilla public licen[sc]e( version| v)? 1 1
mpl-1.1 | mpl | mpl( version| v)? 1 1
mpl-1.0 | mozilla | mozilla public licen[sc]e( version| v)? 1 0
epl-2.0 | eclipse | eclipse public licen[sc]e( version| v)? 2( 0)?
epl-2.0 | epl | epl( version| v)? 2 0
epl-2.0 | eclipse | (www )?eclipse org legal epl( 2 0| v20)
epl-1.0 | eclipse | eclipse public licen[sc]e( version| v)? 1( 0)?
epl-1.0 | epl | epl( version| v)? 1 0
epl-1.0 | eclipse | (www )?eclipse org legal epl v10
cddl-1.0 | development | common development and distribution licen[sc]e( cddl)?( version| v)? 1 0
cddl-1.1 | development | common development and distribution licen[sc]e( cddl)?( version| v)? 1 1
cddl-1.0 | cddl | cddl( version| v)? 1 0
cddl-1.1 | cddl | cddl( version| v)? 1 1
cpl-1.0 | common | common public licen[sc]e( version| v)?( 1 0)?
eupl-1.2 | eupl | eupl( version| v)? 1 2
eupl-1.1 | eupl | eupl( version| v)? 1 1
eupl | european | european union public licen[sc]e
bsl-1.0 | boost | boost software licen[sc]e( version)?( 1 0)?
bsl-1.0 | boost | (www )?boost org license 1 0
zlib | zlib | zlib( libpng)? licen[sc]e
unlicense | unlicense | (the )?unlicense( org)?
wtfpl | wtfpl | wtfpl( version 2)?
wtfpl | fuck | do what the fuck you want to public licen[sc]e
artistic-2.0 | artistic | artistic licen[sc]e( version)? 2 0
artistic-1.0 | artistic | artistic licen[sc]e( version)? 1 0
artistic | perl | same terms as perl( itself)?
lppl-1.3c | lppl | lppl( version| v)? 1 3c?
lppl | latex | latex project public licen[sc]e
postgresql | postgresql | postgresql licen[sc]e
psf-2.0 | python | python software foundation licen[sc]e( version 2)?
php-3.01 | php | php licen[sc]e( version)? 3 01
ruby | ruby | ruby licen[sc]e
openssl | openssl | openssl licen[sc]e
apsl-2.0 | apple | apple public source licen[sc]e( version)?( 2 0)?
ms-pl | microsoft | microsoft public licen[sc]e
ms-rl | microsoft | microsoft reciprocal licen[sc]e
ncsa | ncsa | (university of illinois )?ncsa( open source)? licen[sc]e
odbl-1.0 | database | open database licen[sc]e( odbl)?( v 1 0)?
odbl-1.0 | odbl | odbl( version| v)? 1 0
odc-by-1.0 | attribution | open data commons attribution licen[sc]e
pddl-1.0 | dedication | public domain dedication and licen[sc]e
sspl-1.0 | server | server side public licen[sc]e
sspl-1.0 | sspl | sspl( version| v)? 1( 0)?
elastic-2.0 | elastic | elastic licen[sc]e( version)?( 2 0)?
busl-1.1 | business | business source licen[sc]e( version)?( 1 1)?
upl-1.0 | permissive | universal permissive licen[sc]e
ofl-1.1 | font | (sil )?open font licen[sc]e( version| v)?( 1 1)?
ofl-1.1 | sil | scripts sil org ofl
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
cecill-2.1 | cecill | cecill( version| v)? 2 1
afl-3.0 | academic | academic free licen[sc]e
osl-3.0 | open | open software licen[sc]e
ecl-2.0 | educational | educational community licen[sc]e
mulanpsl-2.0 | mulan | mulan (permissive software licen[sc]e|psl)( v2)?
w3c | w3c | w3c software( notice and)? licen[sc]e
vim | vim | vim licen[sc]e
zpl-2.1 | zope | zope public licen[sc]e
hpnd | historical | historical permission notice and disclaimer
llama | llama | llama( 2| 3| 3 1| 3 2)? community licen[sc]e
openrail | openrail | (creativeml |bigscience )?openrail( m)?( licen[sc]e)?
openrail | rail | open rail( m)?( licen[sc]e)?
cc-by-nc-nd-4.0 | nd | cc by nc nd( v)? 4 0
cc-by-nc-nd-3.0 | nd | cc by nc nd( v)? 3 0
cc-by-nc-nd | nd | cc by nc nd
cc-by-nc-sa-4.0 | sa | cc by nc sa( v)? 4 0
cc-by-nc-sa-3.0 | sa | cc by nc sa( v)? 3 0
cc-by-nc-sa | sa | cc by nc sa
cc-by-nc-4.0 | nc | cc by nc( v)? 4 0
cc-by-nc-3.0 | nc | cc by nc( v)? 3 0
cc-by-nc | nc | cc by nc
cc-by-nd-4.0 | nd | cc by nd( v)? 4 0
cc-by-nd-3.0 | nd | cc by nd( v)? 3 0
cc-by-nd | nd | cc by nd
cc-by-sa-4.0 | sa | cc by sa( v)? 4 0
cc-by-sa-3.0 | sa | cc by sa( v)? 3 0
cc-by-sa-2.5 | sa | cc by sa( v)? 2 5
cc-by-sa | sa | cc by sa
cc-by-4.0 | cc | cc by( v)? 4 0
cc-by-3.0 | cc | cc by( v)? 3 0
cc-by-2.5 | cc | cc by( v)? 2 5
cc-by-2.0 | cc | cc by( v)? 2 0
cc-by-nc-nd | attribution | creative commons attribution non ?commercial no ?deriv(ative)?s?
cc-by-nc-nd | noncommercial | attribution noncommercial no ?derivatives( 4 0)?( international)?
cc-by-nc-sa | attribution | (creative commons )?attribution non ?commercial share ?alike( 4 0| 3 0)?( international| unported)?
cc-by-nc | noncommercial | (creative commons )?attribution noncommercial( 4 0| 3 0)?( international| unported)?
cc-by-nc | commercial | creative commons attribution non commercial( 4 0| 3 0)?( international| unported)?
cc-by-sa | sharealike | (creative commons )?attribution sharealike( 4 0| 3 0)?( international| unported)?
cc-by-sa | alike | creative commons attribution share alike( 4 0| 3 0)?( international| unported)?
cc-by-nd | noderivatives | (creative commons )?attribution noderivatives( 4 0| 3 0)?( international| unported)?
cc-by-4.0 | creative | creative commons attribution 4 0( international)?( public)?( licen[sc]e)?
cc-by-3.0 | creative | creative commons attribution 3 0( unported)?( licen[sc]e)?
cc-by | creative | creative commons attribution( licen[sc]e)?
cc-by-nc-nd | creativecommons | creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc-sa | creativecommons | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc | creativecommons | creativecommons org licenses by nc [1-4] [05]
cc-by-nd | creativecommons | creativecommons org licenses by nd [1-4] [05]
cc-by-sa | creativecommons | creativecommons org licenses by sa [1-4] [05]
cc-by | creativecommons | creativecommons org licenses by [1-4] [05]
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
public-domain | creativecommons | creativecommons org publicdomain mark 1 0
cc0-1.0 | cc0 | cc0( version)? 1 0( universal)?
cc0-1.0 | zero | creative commons zero( v1 0| 1 0)?( universal)?
cc0-1.0 | cc0 | cc0( licen[sc]e)?
crown-copyright | crown | crown copyright
ogl-uk | government | open government licen[sc]e( v)?( [123] 0)?
"""

#: Short names and general statements.
MENTIONS = """
gpl | general | general public licen[sc]e
gpl | gpl | (gnu )?gpl( licen[sc]ed?)?
lgpl | lgpl | lgpl( licen[sc]ed?)?
agpl | agpl | agpl( licen[sc]ed?)?
apache | apache | apache licen[sc]ed?
bsd | bsd | bsd( style)? licen[sc]ed?
mpl | mozilla | mozilla public licen[sc]e
epl | eclipse | eclipse public licen[sc]e
cddl | cddl | cddl
eupl | eupl | eupl
cecill | cecill | cecill
artistic | artistic | artistic licen[sc]e
cc-by | cc | cc by
cc | creative | (under|using)( a| the)? creative commons( licen[sc]e)?
cc | creative | creative commons licen[sc]ed?
copyleft | copyleft | copyleft
public-domain | domain | (in|into|to) the public domain
public-domain | domain | public domain (work|software|text|dedication)
reserved | reserved | all rights reserved
reserved | reserved | (some|no) rights reserved
reserved | droits | tous droits reserves
reserved | droits | tous droits réservés
reserved | rechte | alle rechte vorbehalten
reserved | derechos | todos los derechos reservados
copyright | copyright | copyright( c| ©)?( by)? (19|20)[0-9][0-9]
copyright | copyright | © copyright
copyright | copyright | copyright c
copyright | © | © (19|20)[0-9][0-9]
copyright | copyright | copyright (holder|holders|owner|owners|notice)
proprietary | agreement | end user licen[sc]e agreement( eula)?
proprietary | proprietary | proprietary (licen[sc]e|software|information)
proprietary | trade | trade secrets? of
non-commercial | commercial | (for )?non commercial (use|purposes)( only)?
non-commercial | noncommercial | (for )?noncommercial (use|purposes)( only)?
non-commercial | personal | for personal use only
research-only | research | (for )?research (use|purposes) only
open-source | source | open source licen[sc]ed?
open-source | osi | osi approved( licen[sc]e)?
free-use | royalty | royalty free licen[sc]e
dual | dual | dual licen[sc]ed
licence-file | license | see( the)? license( file| txt| md)? for( more)? details
licence-file | copying | see( the)?( file)? copying
licence-notice | licensed | (is |are )?licensed under( the| a)?
licence-notice | license | released under( the| a)?<4> license
"""

#: Tiers in order of priority, with the weight of a detection.
TIERS = (("identifier", 1.0), ("grant", 0.95), ("name", 0.8), ("mention", 0.4))


def _lines(text: str, tier: int):
    for line in text.strip().splitlines():
        label, keyword, pattern = (x.strip() for x in line.split("|", 2))
        yield tier, label, keyword, pattern


def rules() -> list[tuple[int, str, str, str]]:
    """(tier, label, keyword, pattern) of every rule, first ones first."""
    ids = [(0, i, "spdx", "spdx license identifier " + i.replace("-", " ").replace(".", " ")) for i in IDENTIFIERS.split()]
    # of two identifiers the longer comes first: "gpl 2 0" before "gpl"
    ids.sort(key=lambda r: (-len(r[3]), r[3]))
    return ids + [*_lines(GRANTS, 1), *_lines(NAMES, 2), *_lines(MENTIONS, 3)]
