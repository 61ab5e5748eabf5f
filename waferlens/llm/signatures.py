"""Signatures of license bodies and notices, written by hand in the order in which they are tried.

Each line is ``label keyword: words``.  ``a|b`` stands for either word, ``w?``
for a word that may be missing and ``..`` for up to four words of any kind.
The keyword must be one of the words that are always there.
"""

from __future__ import annotations

import re

# Wording of public licenses, in lower case and without punctuation.
TEXT = """
mit hereby: permission is hereby granted free of charge to any person obtaining a copy
mit substantial: the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit sublicense: use copy modify merge publish distribute sublicense and or sell copies
mit noninfringement: fitness for a particular purpose and noninfringement
mit holders: in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit dealings: arising from out of or in connection with the software or the use or other dealings
mit persons: permit persons to whom the software is furnished to do so
x11 consortium: except as contained in this notice the name of .. consortium
isc fee: permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted
isc disclaims: the software is provided as is and the author disclaims all warranties
isc tortious: whether in an action of contract negligence or other tortious action
bsd-0 fee: permission to use copy modify and or distribute this software for any purpose with or without fee
bsd redistribution: redistribution and use in source and binary forms with or without modification are permitted
bsd redistributions: redistributions of source code must retain the above copyright notice
bsd redistributions: redistributions in binary form must reproduce the above copyright notice
bsd-3 endorse: neither the name of .. nor the names of its contributors may be used to endorse or promote products
bsd-3 endorse: the names? of .. may not be used to endorse or promote products derived from this software
bsd contributors: this software is provided by the copyright holders and contributors as is
bsd regents: copyright .. the regents of the university of california
bsd-4 advertising: all advertising materials mentioning features or use of this software must display
bsd exemplary: direct indirect incidental special exemplary or consequential damages
apache compliance: you may not use this file except in compliance with the license
apache applicable: unless required by applicable law or agreed to in writing software
apache contributor: each contributor hereby grants to you a perpetual worldwide
apache irrevocable: non exclusive no charge royalty free irrevocable copyright license
apache conditions: without warranties or conditions of any kind either express or implied
apache licenses: www apache org licenses license 2 0
apache notice: if the work includes a notice text file as part of its distribution
apache contribution: any contribution intentionally submitted for inclusion in the work
apache-1 foundation: this product includes software developed by the apache software foundation
gpl redistribute: is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl hope: in the hope that it will be useful but without any warranty
gpl merchantability: without even the implied warranty of merchantability or fitness for a particular purpose
gpl received: you should have received a copy of the gnu general public license along with
gpl-2-later option: either version 2 of the license or at your option any later version
gpl-3-later option: either version 3 of the license or at your option any later version
gpl-2 version: gnu general public license version 2 june 1991
gpl-3 version: gnu general public license version 3 29 june 2007
gpl verbatim: everyone is permitted to copy and distribute verbatim copies of this license document
gpl freedom: the licenses for most software are designed to take away your freedom to share and change it
gpl freedom: intended to guarantee your freedom to share and change
gpl copyleft: the gnu general public license is a free copyleft license
gpl conveying: conveying verbatim copies
gpl propagate: to propagate a work means to do anything with it
gpl aggregation: mere aggregation of another work not based on the program
gpl-classpath linking: linking this library statically or dynamically with other modules
gpl-classpath exception: as a special exception the copyright holders of this library give you permission to link
lgpl redistribute: is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl redistribute: is free software you can redistribute it and or modify it under the terms of the gnu library general public license
lgpl received: you should have received a copy of the gnu lesser general public license along with
lgpl-2-later option: either version 2 1 of the license or at your option any later version
lgpl library: a program that contains no derivative of any portion of the library
lgpl combined: a combined work is a work produced by combining or linking an application with the library
agpl affero: under the terms of the gnu affero general public license
agpl interacting: all users interacting with it remotely through a computer network
agpl received: you should have received a copy of the gnu affero general public license along with
fdl invariant: with no invariant sections no front cover texts and no back cover texts
fdl manual: the purpose of this license is to make a manual textbook or other functional and useful document free
mpl mozilla: this source code form is subject to the terms of the mozilla public license
mpl obtain: if a copy of the mpl was not distributed with this file you can obtain one at
mpl incompatible: this source code form is incompatible with secondary licenses
mpl-1 contents: the contents of this file are subject to the mozilla public license
mpl covered: means covered software of a particular contributor
epl accompanying: the accompanying program is provided under the terms of this eclipse public license
epl accompanying: this program and the accompanying materials are made available under the terms of the eclipse public license
epl recipient: any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
edl accompanying: the accompanying materials are made available under the terms of the eclipse distribution license
cpl accompanying: the accompanying program is provided under the terms of this common public license
cddl contents: the contents of this file are subject to the terms of the common development and distribution license
cddl header: when distributing covered software include this cddl header
eupl licensed: licensed under the eupl
eupl european: this european union public licence
cecill governed: this software is governed by the cecill
boost hereby: permission is hereby granted free of charge to any person or organization obtaining a copy of the software
boost accompanying: distributed under the boost software license version 1 0 see accompanying file
zlib acknowledgment: an acknowledgment in the product documentation would be appreciated but is not required
zlib misrepresented: the origin of this software must not be misrepresented
zlib altered: altered source versions must be plainly marked as such
zlib implied: this software is provided as is without any express or implied warranty
unlicense unencumbered: this is free and unencumbered software released into the public domain
unlicense successors: to the detriment of our heirs and successors
cc0 waived: to the extent possible under law .. has waived all copyright
cc0 dedicated: dedicated .. to the public domain by waiving all .. rights
cc0 universal: creative commons cc0 1 0 universal
public-domain hereby: the authors? hereby disclaims? copyright to this source code
public-domain blessing: in place of a legal notice here is a blessing
public-domain placed: placed .. in the public domain
wtfpl fuck: do what the fuck you want to public license
wtfpl fuck: you just do what the fuck you want to
beerware beer: if we meet some day and you think this stuff is worth it you can buy me a beer
cc attribution: licensed under a creative commons attribution
cc-by attribution: creative commons attribution 1|2|3|4 0|5 international|generic|unported license
cc-by-sa sharealike: creative commons attribution sharealike
cc-by-sa alike: creative commons attribution share alike
cc-by-nc noncommercial: creative commons attribution noncommercial
cc-by-nc commercial: creative commons attribution non commercial
cc-by-nd noderivatives: creative commons attribution noderivatives
cc-by-nd noderivs: creative commons attribution noderivs
cc-by-nc-sa noncommercial: creative commons attribution noncommercial sharealike
cc-by-nc-nd noncommercial: creative commons attribution noncommercial noderivatives|noderivs
cc-by-nc commercial: you may not use the material for commercial purposes
cc-by-sa contributions: you must distribute your contributions under the same license as the original
cc-by credit: you must give appropriate credit provide a link to the license and indicate if changes were made
cc creativecommons: creativecommons org licenses
cc-by creativecommons: creativecommons org licenses by 1|2|3|4
cc-by-sa creativecommons: creativecommons org licenses by sa
cc-by-nc creativecommons: creativecommons org licenses by nc
cc-by-nd creativecommons: creativecommons org licenses by nd
cc0 creativecommons: creativecommons org publicdomain zero
ofl reserved: with reserved font name
ofl font: this font software is licensed under the sil open font license
ofl bundled: the fonts .. may be bundled embedded redistributed and or sold with any software
artistic intent: the intent of this document is to state the conditions under which a package may be copied
artistic perl: same terms as perl itself
artistic standard: you may copy and distribute verbatim .. copies of the standard version
php php: this product includes php software freely available
psf python: this license agreement is between the python software foundation
psf python: copyright .. python software foundation all rights reserved
openssl openssl: this product includes software developed by the openssl project
openssl cryptographic: this product includes cryptographic software written by eric young
ms-pl accept: if you use the software you accept this license if you do not accept the license do not use the software
ms-rl reciprocal: microsoft reciprocal license
ncsa opensource: university of illinois .. opensource
ncsa deal: to deal with the software without restriction including without limitation
lppl latex: this work may be distributed and or modified under the conditions of the latex project public license
lppl maintenance: this work has the lppl maintenance status
vim vim: there are no restrictions on distributing unmodified copies of vim
icu unicode: permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
hpnd supporting: that both that copyright notice and this permission notice appear in supporting documentation
hpnd publicity: not be used in advertising or publicity pertaining to distribution
ijg jpeg: this software is based in part on the work of the independent jpeg group
postgresql postgresql: permission to use copy modify and distribute this software and its documentation .. postgresql
sleepycat sleepycat: redistributions in any form must be accompanied by information on how to obtain complete source code .. sleepycat
odbl database: this .. database is made available under the open database license
odbl contents: any rights in individual contents of the database are licensed under the database contents license
ecl educational: licensed under the educational community license
osl open: licensed under the open software license version
afl academic: licensed under the academic free license version
upl universal: the universal permissive license
mulan mulan: you can use this software according to the terms and conditions of the mulan psl
proprietary confidential: this .. contains confidential and proprietary information
proprietary unauthorized: unauthorized copying of this file via any medium is strictly prohibited
proprietary disclosure: any use disclosure or reproduction .. is strictly prohibited
proprietary written: may not be reproduced .. without the prior written permission
proprietary redistribute: you may not copy modify redistribute
proprietary evaluation: licensed for evaluation purposes only
eula agreement: end user license agreement
eula reverse: you may not reverse engineer decompile or disassemble
warranty warranty: provided as is without warranty of any kind express or implied
warranty liable: in no event shall .. be liable for any
warranty merchantability: implied warranties of merchantability
warranty disclaimed: fitness for a particular purpose are disclaimed
permission permission: used with permission of the copyright holder
permission reprinted: reprinted with permission
noncommercial noncommercial: for noncommercial use only
noncommercial commercial: for non commercial use only
noncommercial research: for research purposes only
"""


def _word(w: str) -> str:
    if w == "..":
        return "(?: [^ ]+ ){0,4}"
    forms = "|".join(f" {x} " for x in w.rstrip("?").split("|"))
    many = "|" in w
    return f"(?:{forms})?" if w.endswith("?") else f"(?:{forms})" if many else forms


def signatures() -> list[tuple[str, str, str]]:
    """(label, keyword, pattern over wrapped words) of every line, in order."""
    found = []
    for line in TEXT.strip().splitlines():
        label, keyword, words = re.fullmatch(r"(\S+) (\S+): (.+)", line).groups()
        if keyword not in words.split():
            raise ValueError(f"the keyword is no fixed word of its signature: {line}")
        found.append((label, keyword, "".join(map(_word, words.split()))))
    return found
