"""The rule set of the license scan.

Rules are regexes over normalised text: lower-case words, one space between two.
A rule is a hand-written passage of a license, a notice, an address or an
exception, or one of a few templates around the name of a license family. Order is
rank: a smaller priority is stronger.

The prefilter is derived from the rules, not written beside them. ``mandatory`` reads
off a regex what each of its matches must hold; a rule is tried on texts only that
hold one of its keywords, and ``GATE`` stops texts that no rule can match.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple


class Rule(NamedTuple):
    """A text is tried against ``pattern`` only if it holds one of ``keywords``, as whole words.

    Patterns are made of words, spaces, groups ``(?:a|b)`` and ``(?:a)?``, which never
    divide a word, and ``…``, which stands for up to ten words."""

    priority: int
    label: str
    pattern: str
    keywords: tuple[str, ...] = ()


#: Words that ``…`` stands for, at most.
GAP = 10

#: Weight of a detection by priority; the score of a text is its best detection's.
WEIGHTS = {0: 1.0, 1: 1.0, 2: 0.9, 3: 0.7, 4: 0.5}

#: The base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Fixed values: (label, regex of the name, words of the SPDX identifier).
FAMILIES = [
    ("0bsd", "(?:bsd zero clause|zero clause bsd|0bsd)", "0bsd"),
    ("afl-3.0", "academic free license(?: (?:version |v )?3 0)?", "afl 3 0"),
    ("agpl-3.0", "(?:gnu )?affero general public license(?: (?:version |v )?3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("apache", "apache(?: software)? license", "apache"),
    ("apache-1.1", "apache(?: software)? license (?:version |v )?1 1", "apache 1 1"),
    ("apache-2.0", "apache(?: software)?(?: license)? (?:version |v )?2 0", "apache 2 0"),
    ("artistic-2.0", "artistic license(?: (?:version |v )?2 0)?", "artistic 2 0"),
    ("bsd-2-clause", "(?:simplified bsd|freebsd|(?:bsd )?2 clause bsd|bsd 2 clause|two clause bsd)", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|(?:bsd )?3 clause bsd|bsd 3 clause|three clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original bsd|4 clause bsd|bsd 4 clause|four clause bsd)", "bsd 4 clause"),
    ("bsd", "(?:bsd|berkeley software distribution)", "bsd"),
    ("bsl-1.0", "boost software license(?: (?:version |v )?1 0)?", "bsl 1 0"),
    ("busl-1.1", "business source license(?: (?:version |v )?1 1)?", "busl 1 1"),
    ("cc0-1.0", "cc0(?: (?:version |v )?1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-4.0", "creative commons attribution(?: 4 0)?(?: international)?", "cc by 4 0"),
    ("cc-by-3.0", "creative commons attribution 3 0(?: unported)?", "cc by 3 0"),
    ("cc-by-sa-4.0", "creative commons attribution (?:sharealike|share alike)(?: 4 0)?(?: international)?", "cc by sa 4 0"),
    ("cc-by-sa-3.0", "creative commons attribution (?:sharealike|share alike) 3 0(?: unported)?", "cc by sa 3 0"),
    ("cc-by-nc-4.0", "creative commons attribution (?:noncommercial|non commercial)(?: 4 0)?(?: international)?", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution (?:noderivatives|no derivatives)(?: 4 0)?(?: international)?", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike)(?: 4 0)?(?: international)?", "cc by nc sa 4 0"),
    ("cddl-1.0", "common development and distribution license(?: (?:version |v )?1 0)?", "cddl 1 0"),
    ("cecill-2.1", "cecill(?: free software)?(?: license)?(?: (?:version |v )?2 1)?", "cecill 2 1"),
    ("cpl-1.0", "common public license(?: (?:version |v )?1 0)?", "cpl 1 0"),
    ("curl", "curl license", "curl"),
    ("ecl-2.0", "educational community license(?: (?:version |v )?2 0)?", "ecl 2 0"),
    ("elastic-2.0", "elastic license(?: (?:version |v )?2 0)?", "elastic 2 0"),
    ("epl-1.0", "eclipse public license (?:version |v )?1 0", "epl 1 0"),
    ("epl-2.0", "eclipse public license(?: (?:version |v )?2 0)?", "epl 2 0"),
    ("eupl-1.2", "european union public (?:license|licence)(?: (?:version |v )?1 2)?", "eupl 1 2"),
    ("gfdl-1.3", "(?:gnu )?free documentation license(?: (?:version |v )?1 3)?", "gfdl 1 3"),
    ("gpl", "(?:gnu )?general public license", "gpl"),
    ("gpl-2.0", "(?:gnu )?general public license (?:version |v )?2(?: 0)?(?: or later| or any later version)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "(?:gnu )?general public license (?:version |v )?3(?: 0)?(?: or later| or any later version)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2.0-short", "(?:gnu )?(?:gplv2|gpl v2|gpl 2(?: 0)?)", "gpl2"),
    ("gpl-3.0-short", "(?:gnu )?(?:gplv3|gpl v3|gpl 3(?: 0)?)", "gpl3"),
    ("icu", "icu license", "icu"),
    ("ijg", "independent jpeg group license", "ijg"),
    ("isc", "(?:isc|internet systems consortium)", "isc"),
    ("lgpl", "(?:gnu )?lesser general public license", "lgpl"),
    ("lgpl-2.1", "(?:gnu )?lesser general public license (?:version |v )?2 1(?: or later)?", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "(?:gnu )?lesser general public license (?:version |v )?3(?: 0)?(?: or later)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "(?:gnu )?library general public license(?: (?:version |v )?2(?: 0)?)?", "lgpl 2 0(?: only| or later)?"),
    ("lppl-1.3c", "latex project public license(?: (?:version |v )?(?:1 3|1 3c))?", "lppl 1 3c"),
    ("libpng", "(?:libpng|png) license", "libpng"),
    ("mit", "(?:mit|expat|mit x11)", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("mpl-1.1", "mozilla public license (?:version |v )?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla public license(?: (?:version |v )?2 0)?", "mpl 2 0"),
    ("ms-pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl"),
    ("ncsa", "university of illinois(?: ncsa)? open source license", "ncsa"),
    ("odbl-1.0", "open database license(?: (?:version |v )?1 0)?", "odbl 1 0"),
    ("ofl-1.1", "(?:sil )?open font license(?: (?:version |v )?1 1)?", "ofl 1 1"),
    ("openssl", "openssl license", "openssl"),
    ("osl-3.0", "open software license(?: (?:version |v )?3 0)?", "osl 3 0"),
    ("php-3.01", "php license(?: (?:version |v )?3 01)?", "php 3 01"),
    ("postgresql", "postgresql license", "postgresql"),
    ("psf-2.0", "python software foundation license(?: (?:version |v )?2)?", "psf 2 0"),
    ("ruby", "ruby license", "ruby"),
    ("sleepycat", "sleepycat license", "sleepycat"),
    ("sspl-1.0", "server side public license(?: (?:version |v )?1)?", "sspl 1 0"),
    ("unlicense", "(?:the )?unlicense", "unlicense"),
    ("upl-1.0", "universal permissive license(?: (?:version |v )?1 0)?", "upl 1 0"),
    ("vim", "vim license", "vim"),
    ("w3c", "w3c software(?: notice and)? license", "w3c"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public license)", "wtfpl"),
    ("x11", "x11 license", "x11"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("zpl-2.1", "zope public license(?: (?:version |v )?2 1)?", "zpl 2 1"),
]

#: Fixed values: (priority, regex around a family's name with the word license {l}, its
#: identifier {i} or name or identifier {e}).
TEMPLATES = [
    (0, "spdx license identifier {i}"),
    (1, "spdx license identifier… (?:and|or) {i}"),
    (1, "(?:licensed|licenced) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{e}(?: (?:license|licence))?"),
    (2, "(?:released under|distributed under|published under|provided under|available under|covered under) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{e}(?: (?:license|licence))?"),
    (3, "(?:see|read|under|per|accept|of) the {l}"),
    (4, "{l}"),
]

#: Passages of permissive licenses.
PERMISSIVE = [
    (1, "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (1, "mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    (1, "mit", "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    (1, "mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (1, "mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    (1, "mit", "use of this source code is governed by an? mit style license"),
    (1, "json", "the software shall be used for good not evil"),
    (1, "x11", "except as contained in this notice the name of… shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    (1, "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (1, "isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (1, "0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (1, "isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    (1, "ntp", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that the above copyright notice appears in all copies"),
    (1, "hpnd", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and)? without fee is hereby granted provided that the above copyright notice appear in all copies"),
    (1, "hpnd", "not be used in advertising or publicity pertaining to distribution of the software without specific(?: written)? prior(?: written)? permission"),
    (1, "postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    (1, "smlnj", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies and that both"),
    (1, "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (1, "bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    (1, "bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (1, "bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    (1, "bsd", "this software is provided by the (?:copyright holders?|regents|authors?) and contributors as is and any express or implied warranties"),
    (1, "bsd", "use of this source code is governed by a bsd style license"),
    (1, "bsd-3-clause", "neither the names? of… nor the names of(?: its)? contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    (1, "bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    (1, "bsd-4-clause-uc", "this product includes software developed by the university of california berkeley and its contributors"),
    (1, "bsd-3-clause-clear", "no express or implied licenses to any party s patent rights are granted by this license"),
    (1, "bsd-2-clause-patent", "each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    (1, "bsd-protection", "bsd protection license february 2002"),
    (1, "ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    (1, "ncsa", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    (1, "apache-2.0", "you may not use this file except in compliance with the license"),
    (1, "apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    (1, "apache-2.0", "see the license for the specific language governing permissions and limitations under the license"),
    (1, "apache-2.0", "apache license version 2 0 january 2004"),
    (1, "apache-2.0", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license"),
    (1, "apache-2.0", "licensed to the apache software foundation(?: asf)? under one or more contributor license agreements"),
    (1, "apache-1.1", "this product includes software developed by the apache (?:software foundation|group)"),
    (1, "apache-1.1", "the apache software license version 1 1"),
    (1, "bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    (1, "bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    (1, "bsl-1.0", "this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software"),
    (1, "bsl-1.0", "boost software license version 1 0 august 17th 2003"),
    (1, "zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    (1, "zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    (1, "zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    (1, "zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    (1, "zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    (1, "bzip2-1.0.6", "this program bzip2 the associated library libbzip2 and all documentation are copyright"),
    (1, "libpng", "the png reference library is supplied as is the contributing authors and group 42 inc disclaim all warranties"),
    (1, "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    (1, "openssl", "this product includes cryptographic software written by eric young"),
    (1, "ijg", "permission is hereby granted to use copy modify and distribute this software or portions thereof for any purpose without fee"),
    (1, "ijg", "this software is based in part on the work of the independent jpeg group"),
    (1, "ftl", "portions of this software are copyright… the freetype project"),
    (1, "ftl", "the freetype project is copyright"),
    (1, "tcl", "the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    (1, "info-zip", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the above disclaimer"),
    (1, "psf-2.0", "this license agreement is between the python software foundation psf and the individual or organization licensee"),
    (1, "psf-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    (1, "python-2.0", "beopen python open source license agreement version 1"),
    (1, "cnri-python", "cnri license agreement for python"),
    (1, "php-3.01", "this source file is subject to version 3 01 of the php license"),
    (1, "php-3.0", "this source file is subject to version 3 0 of the php license"),
    (1, "php-3.01", "this product includes php software freely available from"),
    (1, "zpl-2.1", "this software is subject to the provisions of the zope public license version 2 1"),
    (1, "zpl-2.0", "this software is subject to the provisions of the zope public license version 2 0"),
    (1, "w3c", "by obtaining using and or copying this work you the licensee agree that you have read understood and will comply with the following terms and conditions"),
    (1, "w3c", "permission to copy modify and distribute this software and its documentation with or without modification for any purpose and without fee or royalty is hereby granted"),
    (1, "icu", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction… provided that the above copyright notice s and this permission notice appear in all copies"),
    (1, "unicode-dfs-2016", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files and any associated documentation"),
    (1, "unicode-dfs-2016", "unicode inc license agreement data files and software"),
    (1, "afl-3.0", "licensed under the academic free license version 3 0"),
    (1, "afl-2.1", "licensed under the academic free license version 2 1"),
    (1, "ecl-2.0", "licensed under the educational community license version 2 0"),
    (1, "upl-1.0", "the universal permissive license upl version 1 0"),
    (1, "ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    (1, "beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    (1, "beerware", "the beer ware license revision 42"),
    (1, "wtfpl", "you just do what the fuck you want to"),
    (1, "wtfpl", "do what the fuck you want to public license version 2 december 2004"),
    (1, "wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
    (1, "unlicense", "this is free and unencumbered software released into the public domain"),
    (1, "unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    (1, "unlicense", "dedicate any and all copyright interest in the software to the public domain"),
    (1, "fair", "usage of the works is permitted provided that this instrument is retained with the works"),
    (1, "mulanpsl-2.0", "you can use this software according to the terms and conditions of the mulan psl v2"),
    (1, "blueoak-1.0.0", "this license gives everyone as much permission to work with this software as possible while protecting contributors from liability"),
    (1, "naist-2003", "use reproduction and distribution of this software is permitted any copy of this software whether in its original form or modified must include both the above copyright notice"),
    (1, "imagemagick", "licensed under the imagemagick license"),
    (1, "vim", "there are no restrictions on distributing unmodified copies of vim"),
]

#: Passages of licenses that ask for the same license in return.
RECIPROCAL = [
    (1, "gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    (1, "gpl-2.0-or-later", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    (1, "gpl-3.0-or-later", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (1, "gpl-2.0-only", "under the terms of the gnu general public license version 2 as published by the free software foundation"),
    (1, "gpl-2.0-only", "under the terms of version 2 of the gnu general public license"),
    (1, "gpl-3.0-only", "under the terms of (?:the gnu general public license version 3|version 3 of the gnu general public license)"),
    (1, "gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    (1, "gpl", "you should have received a copy of the gnu general public license along with this program"),
    (1, "gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    (1, "gpl-2.0", "gnu general public license version 2 june 1991"),
    (1, "gpl-3.0", "gnu general public license version 3 29 june 2007"),
    (1, "gpl-1.0", "gnu general public license version 1 february 1989"),
    (1, "gpl", "the licenses for most software are designed to take away your freedom to share and change it"),
    (1, "lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    (1, "lgpl-2.1-or-later", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    (1, "lgpl-3.0-or-later", "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (1, "lgpl-2.0-or-later", "gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    (1, "lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:library|program)"),
    (1, "lgpl-2.1", "gnu lesser general public license version 2 1 february 1999"),
    (1, "lgpl-3.0", "gnu lesser general public license version 3 29 june 2007"),
    (1, "lgpl-2.0", "gnu library general public license version 2 june 1991"),
    (1, "agpl-3.0", "under the terms of the gnu affero general public license"),
    (1, "agpl-3.0-or-later", "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (1, "agpl-3.0", "you should have received a copy of the gnu affero general public license along with this program"),
    (1, "agpl-3.0", "gnu affero general public license version 3 19 november 2007"),
    (1, "gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    (1, "gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    (1, "mpl-2.0", "this source code form is subject to the terms of the mozilla public license(?: v 2 0)?"),
    (1, "mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    (1, "mpl-2.0-no-copyleft-exception", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    (1, "mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    (1, "mpl-1.0", "the contents of this file are subject to the mozilla public license version 1 0"),
    (1, "npl-1.1", "the contents of this file are subject to the netscape public license version 1 1"),
    (1, "mpl-1.1", "alternatively the contents of this file may be used under the terms of either the gnu general public license version 2 or later"),
    (1, "epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v 1 0|1 0|v1 0|version 1 0)"),
    (1, "epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v 2 0|2 0|v2 0|version 2 0)"),
    (1, "edl-1.0", "made available under the terms of the eclipse distribution license"),
    (1, "epl", "the accompanying program is provided under the terms of this eclipse public license"),
    (1, "cpl-1.0", "the accompanying program is provided under the terms of this common public license"),
    (1, "ipl-1.0", "the accompanying program is provided under the terms of this ibm public license"),
    (1, "cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license"),
    (1, "cddl-1.0", "do not alter or remove copyright notices or this file header"),
    (1, "osl-3.0", "licensed under the open software license version 3 0"),
    (1, "eupl-1.1", "licensed under the eupl version 1 1 or as soon they will be approved by the european commission subsequent versions of the eupl"),
    (1, "eupl-1.2", "licensed under the eupl version 1 2 or as soon they will be approved by the european commission subsequent versions of the eupl"),
    (1, "eupl", "licensed under the eupl"),
    (1, "cecill-2.1", "this software is governed by the cecill license under french law and abiding by the rules of distribution of free software"),
    (1, "cecill-b", "this software is governed by the cecill b license under french law"),
    (1, "cecill-c", "this software is governed by the cecill c license under french law"),
    (1, "lppl-1.3c", "this work may be distributed and or modified under the conditions of the latex project public license"),
    (1, "lppl-1.3c", "this work has the lppl maintenance status"),
    (1, "artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied"),
    (1, "artistic-2.0", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    (1, "artistic-1.0-perl", "(?:you can redistribute it and or modify it|it may be redistributed and or modified) under the same terms as perl itself"),
    (1, "ruby", "you may make and give away verbatim copies of the source form of the software without restriction"),
    (1, "sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code for the db software"),
    (1, "qpl-1.0", "this file may be distributed under the terms of the q public license"),
    (1, "ms-rl", "microsoft reciprocal license ms rl"),
    (1, "ms-pl", "microsoft public license ms pl"),
    (1, "cpal-1.0", "the contents of this file are subject to the common public attribution license version 1 0"),
    (1, "apsl-2.0", "subject to the apple public source license version 2 0"),
    (1, "ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    (1, "ofl-1.1", "sil open font license version 1 1 26 february 2007"),
    (1, "ofl-1.1", "no modified version of the font software may use the reserved font name"),
    (1, "sspl-1.0", "server side public license version 1 october 16 2018"),
    (1, "sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available"),
    (1, "cern-ohl-s-2.0", "cern open hardware (?:licence|license) version 2 strongly reciprocal"),
    (1, "cern-ohl-w-2.0", "cern open hardware (?:licence|license) version 2 weakly reciprocal"),
    (1, "cern-ohl-p-2.0", "cern open hardware (?:licence|license) version 2 permissive"),
    (1, "tapr-ohl-1.0", "licensed under the tapr open hardware license"),
]

#: Exceptions that are granted beside a license.
EXCEPTIONS = [
    (1, "classpath-exception-2.0", "linking this library statically or dynamically with other modules is making a combined work based on this library"),
    (1, "classpath-exception-2.0", "subject to the classpath exception as provided"),
    (1, "gcc-exception-3.1", "you are granted additional permissions described in the gcc runtime library exception"),
    (1, "gcc-exception-2.0", "the free software foundation gives you unlimited permission to link the compiled version of this file"),
    (1, "autoconf-exception-2.0", "if you distribute this file as part of a program that contains a configuration script generated by autoconf you may include it under the same distribution terms"),
    (1, "libtool-exception", "if you distribute this file as part of a program or library that is built using gnu libtool"),
    (1, "bison-exception-2.2", "you may create a larger work that contains part or all of the bison parser skeleton and distribute that work under terms of your choice"),
    (1, "font-exception-2.0", "if you create a document which uses this font and embed this font or unaltered portions of this font into the document"),
    (1, "openssl-exception", "permission to link the code of (?:portions of this program|this program) with the openssl library"),
    (1, "llvm-exception", "if as a result of your compiling your source code portions of this software are embedded into an object form of such source code you may redistribute such embedded portions"),
    (1, "linux-syscall-note", "this copyright does not cover user programs that use kernel services by normal system calls"),
    (1, "wxwindows-exception-3.1", "the copyright holders of this library give permission for additional uses of the text contained in this release of the library as licensed under the wxwindows library licence"),
    (1, "ecos-exception-2.0", "if other files instantiate templates or use macros or inline functions from this file"),
    (1, "qt-lgpl-exception-1.1", "digia qt lgpl exception version 1 1"),
    (1, "qt-gpl-exception-1.0", "the qt company gpl exception 1 0"),
    (1, "swift-exception", "runtime library exception to the apache 2 0 license"),
    (1, "commons-clause", "commons clause license condition v1 0"),
    (1, "commons-clause", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
]

#: Names of exceptions as an SPDX expression has them after WITH.
SPDX_EXCEPTIONS = [
    ("classpath-exception-2.0", "classpath exception 2 0"), ("gcc-exception-3.1", "gcc exception 3 1"), ("gcc-exception-2.0", "gcc exception 2 0"),
    ("autoconf-exception-2.0", "autoconf exception 2 0"), ("autoconf-exception-3.0", "autoconf exception 3 0"), ("bison-exception-2.2", "bison exception 2 2"),
    ("font-exception-2.0", "font exception 2 0"), ("openssl-exception", "openvpn openssl exception"), ("llvm-exception", "llvm exception"),
    ("linux-syscall-note", "linux syscall note"), ("libtool-exception", "libtool exception"), ("swift-exception", "swift exception"),
    ("wxwindows-exception-3.1", "wxwindows exception 3 1"), ("ecos-exception-2.0", "ecos exception 2 0"), ("qt-lgpl-exception-1.1", "qt lgpl exception 1 1"),
]

#: Licenses of works other than programs, and of models and data.
CONTENT = [
    (1, "cc-by-4.0", "this work is licensed under (?:a|the) creative commons attribution 4 0 international license"),
    (1, "cc-by-sa-4.0", "this work is licensed under (?:a|the) creative commons attribution (?:sharealike|share alike) 4 0 international license"),
    (1, "cc-by-nc-4.0", "this work is licensed under (?:a|the) creative commons attribution (?:noncommercial|non commercial) 4 0 international license"),
    (1, "cc-by-nc-sa-4.0", "this work is licensed under (?:a|the) creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike) 4 0 international license"),
    (1, "cc-by-nc-nd-4.0", "this work is licensed under (?:a|the) creative commons attribution (?:noncommercial|non commercial) (?:noderivatives|no derivatives|noderivs) 4 0 international license"),
    (1, "cc-by-nd-4.0", "this work is licensed under (?:a|the) creative commons attribution (?:noderivatives|no derivatives|noderivs) 4 0 international license"),
    (1, "cc-by-3.0", "this work is licensed under (?:a|the) creative commons attribution 3 0 (?:unported|united states) license"),
    (1, "cc-by-sa-3.0", "this work is licensed under (?:a|the) creative commons attribution (?:sharealike|share alike) 3 0 (?:unported|united states) license"),
    (1, "cc-by-sa", "text is available under the creative commons attribution (?:sharealike|share alike) license"),
    (1, "cc0-1.0", "waived all copyright and related or neighboring rights"),
    (1, "cc0-1.0", "cc0 1 0 universal(?: cc0 1 0)? public domain dedication"),
    (1, "cc0-1.0", "has dedicated the work to the public domain by waiving all"),
    (1, "cc-pdm-1.0", "this work has been identified as being free of known restrictions under copyright law"),
    (1, "odbl-1.0", "is made available under the open database license"),
    (1, "odc-by-1.0", "open data commons attribution license"),
    (1, "pddl-1.0", "(?:open data commons )?public domain dedication and license(?: pddl)?"),
    (1, "dbcl-1.0", "any rights in individual contents of the database are licensed under the database contents license"),
    (1, "cdla-permissive-2.0", "community data license agreement permissive(?: version)? 2 0"),
    (1, "cdla-permissive-1.0", "community data license agreement permissive(?: version)? 1 0"),
    (1, "cdla-sharing-1.0", "community data license agreement sharing(?: version)? 1 0"),
    (1, "ogl-uk-3.0", "(?:licensed under the|contains public sector information licensed under the) open government licence v3 0"),
    (1, "ogl-uk", "open government licence for public sector information"),
    (1, "etalab-2.0", "licence ouverte open licence version 2 0"),
    (1, "llama2", "llama 2 community license agreement"),
    (1, "llama3", "(?:meta )?llama 3(?: 1| 2| 3)? community license agreement"),
    (1, "gemma", "gemma is provided under and subject to the gemma terms of use"),
    (1, "bigscience-rail-1.0", "bigscience (?:rail|openrail m) license"),
    (1, "creativeml-openrail-m", "creativeml open ?rail m license"),
    (1, "openrail", "responsible ai license"),
]

#: Licenses that restrict use, and notices that reserve rights.
RESTRICTED = [
    (1, "busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    (1, "busl-1.1", "business source license 1 1 parameters"),
    (1, "elastic-2.0", "you may not provide the software to third parties as a hosted or managed service"),
    (1, "elastic-2.0", "licensed under the elastic license 2 0"),
    (1, "confluent-1.0", "confluent community license agreement(?: version)? 1 0"),
    (1, "rsal", "redis source available license"),
    (1, "polyform-noncommercial-1.0.0", "polyform noncommercial license 1 0 0"),
    (1, "polyform-small-business-1.0.0", "polyform small business license 1 0 0"),
    (1, "polyform-shield-1.0.0", "polyform shield license 1 0 0"),
    (1, "prosperity-3.0.0", "the prosperity public license 3 0 0"),
    (1, "parity-7.0.0", "the parity public license 7 0 0"),
    (1, "anti-996", "anti 996 license"),
    (1, "hippocratic-2.1", "hippocratic license(?: version)? 2 1"),
    (1, "jrl", "java research license"),
    (1, "oracle-bcl", "oracle binary code license agreement"),
    (1, "nvidia", "nvidia (?:software license|end user license) agreement"),
    (1, "intel", "intel simplified software license"),
    (2, "non-commercial", "licensed for (?:non commercial|noncommercial) use only"),
    (2, "academic-use", "permission is granted for academic(?: and)?(?: research)? (?:use|purposes) only"),
    (2, "evaluation", "licensed for evaluation purposes only"),
    (2, "eula", "end user (?:license|licence) agreement"),
    (2, "eula", "you agree to be bound by the terms of this (?:license|licence) agreement"),
    (2, "eula", "(?:this software is licensed not sold|the software is licensed not sold)"),
    (2, "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
    (2, "proprietary", "unauthorized (?:copying|reproduction|distribution) of this (?:file|software|program)… is strictly prohibited(?: proprietary and confidential)?"),
    (2, "proprietary", "this (?:software|file|program) is proprietary(?: software)?"),
    (2, "proprietary", "(?:licensed materials property of|contains proprietary information of)"),
    (2, "proprietary", "without the (?:prior written permission|express written permission|prior written consent) of the copyright (?:holder|owner)"),
    (2, "all-rights-reserved", "all rights reserved"),
    (2, "all-rights-reserved", "alle rechte vorbehalten"),
    (2, "all-rights-reserved", "tous droits reserves"),
    (2, "all-rights-reserved", "todos los derechos reservados"),
]

#: Notices of the public domain, of a choice of licenses, and general ones.
NOTICES = [
    (2, "public-domain", "(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    (2, "public-domain", "(?:this|the) (?:file|code|software|program|work) is(?: hereby)? in the public domain"),
    (2, "public-domain", "public domain software"),
    (2, "us-government-work", "not subject to copyright protection(?: in the united states)?(?: and is in the public domain)?"),
    (2, "us-government-work", "is a work of the u s government and is in the public domain"),
    (1, "apache-2.0-or-mit", "licensed under either of(?: the)? apache license version 2 0… or(?: the)? mit license"),
    (1, "apache-2.0-or-mit", "dual licensed under(?: the)? (?:apache 2 0 and mit|mit and apache 2 0|mit or apache 2 0|apache 2 0 or mit)(?: licenses?)?"),
    (1, "mit-or-gpl", "dual licensed under the (?:mit and gpl|mit or gpl|mit and gplv2|mit or gplv2) licenses?"),
    (1, "bsd-or-gpl", "dual licensed under (?:the )?(?:bsd and gpl|bsd or gpl|dual bsd gpl|gpl and bsd|gpl or bsd)(?: licenses?)?"),
    (1, "bsd-or-gpl", "module license dual bsd gpl"),
    (1, "mit-or-gpl", "module license dual mit gpl"),
    (1, "gpl", "module license gpl(?: v2)?"),
    (1, "proprietary", "module license proprietary"),
    (3, "copyleft", "copyleft (?:license|licence)"),
    (3, "same-as-perl", "same (?:license|licence) as perl(?: itself)?"),
    (3, "same-as-perl", "same terms as perl itself"),
    (3, "same-as-python", "same (?:license|licence) as python(?: itself)?"),
    (3, "same-as-linux", "same (?:license|licence) as (?:the )?linux(?: kernel)?"),
    (3, "same-as-ruby", "same (?:license|licence) as ruby(?: itself)?"),
    (3, "same-as-zlib", "same (?:license|licence) as zlib"),
    (3, "osi-approved", "(?:osi approved|approved by the open source initiative) license"),
    (3, "license-file", "see (?:the )?(?:license|licence)(?: txt| md)? (?:file )?(?:for details|for more information|for more details|in the project root)"),
    (3, "license-file", "(?:license|licence) that can be found in the (?:license|licence|copying) file"),
    (4, "warranty-disclaimer", "without (?:any )?warranty of any kind"),
    (4, "warranty-disclaimer", "without warranties or conditions of any kind"),
    (4, "warranty-disclaimer", "warranties or conditions of any kind"),
    (4, "warranty-disclaimer", "there is no warranty to the extent permitted by (?:applicable )?law"),
    (4, "warranty-disclaimer", "(?:comes|provided) with absolutely no warranty"),
]

#: Addresses at which licenses are found; (label, words of host and path).
ADDRESSES = [
    ("apache-2.0", "apache org licenses license 2 0"), ("gpl-3.0", "gnu org licenses gpl 3 0"), ("gpl-2.0", "gnu org licenses old licenses gpl 2 0"),
    ("gpl", "gnu org licenses gpl"), ("lgpl-3.0", "gnu org licenses lgpl 3 0"), ("lgpl-2.1", "gnu org licenses old licenses lgpl 2 1"), ("lgpl", "gnu org licenses lgpl"),
    ("agpl-3.0", "gnu org licenses agpl 3 0"), ("gfdl-1.3", "gnu org licenses fdl 1 3"), ("gpl", "gnu org copyleft gpl"), ("lgpl", "gnu org copyleft lesser"),
    ("mit", "opensource org licenses mit"), ("mit", "opensource org licenses mit license php"), ("bsd-3-clause", "opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause"), ("bsd", "opensource org licenses bsd license"), ("isc", "opensource org licenses isc"),
    ("apache-2.0", "opensource org licenses apache 2 0"), ("gpl-3.0", "opensource org licenses gpl 3 0"), ("gpl-2.0", "opensource org licenses gpl 2 0"),
    ("lgpl-3.0", "opensource org licenses lgpl 3 0"), ("mpl-2.0", "opensource org licenses mpl 2 0"), ("artistic-2.0", "opensource org licenses artistic license 2 0"),
    ("osl-3.0", "opensource org licenses osl 3 0"), ("afl-3.0", "opensource org licenses afl 3 0"), ("zlib", "opensource org licenses zlib"),
    ("cddl-1.0", "opensource org licenses cddl1"), ("cpl-1.0", "opensource org licenses cpl1 0"), ("epl-1.0", "opensource org licenses eclipse 1 0"),
    ("mpl-2.0", "mozilla org mpl 2 0"), ("mpl-1.1", "mozilla org mpl mpl 1 1"), ("epl-1.0", "eclipse org legal epl v10"), ("epl-2.0", "eclipse org legal epl 2 0"),
    ("epl-2.0", "eclipse org legal epl v20"), ("bsl-1.0", "boost org license 1 0 txt"), ("unlicense", "unlicense org"), ("ofl-1.1", "scripts sil org ofl"),
    ("ofl-1.1", "openfontlicense org"), ("wtfpl", "wtfpl net"), ("php-3.01", "php net license 3 01 txt"), ("cc0-1.0", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm-1.0", "creativecommons org publicdomain mark 1 0"), ("cc-by-4.0", "creativecommons org licenses by 4 0"), ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0"), ("cc-by-nd-4.0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0"), ("cc-by-nc-nd-4.0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0"), ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0"), ("cc-by-nc-3.0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-sa-3.0", "creativecommons org licenses by nc sa 3 0"), ("cc-by-2.0", "creativecommons org licenses by 2 0"), ("cc-by-sa-2.0", "creativecommons org licenses by sa 2 0"),
    ("odbl-1.0", "opendatacommons org licenses odbl"), ("odc-by-1.0", "opendatacommons org licenses by"), ("pddl-1.0", "opendatacommons org licenses pddl"),
    ("lppl-1.3c", "latex project org lppl"), ("cecill-2.1", "cecill info licences"), ("zpl-2.1", "zope org resources zpl"),
    ("artistic-1.0", "perlfoundation org artistic license"), ("python-2.0", "python org psf license"),
]

#: A text without any of these cannot match a rule or a base phrase; ``rules`` proves it.
GATE = (
    "licen", "spdx", "permission", "permitted", "redistribut", "free software", "public domain", "reserv", "propriet", "copyleft", "copyright", "warrant",
    "compliance", "released under", "distributed under", "published under", "provided under", "available under", "covered under", "under the terms of", "strictly prohibited",
    "this software", "the software", "this product includes", "this notice", "unmodified copies", "source versions", "perl itself", "exception", " org ", "wtfpl", "lppl",
    "do what the fuck", "cover texts", " the mpl ", "a package may be", "service source code", "combined work", "as part of a program", "bison", "this font", "inline functions", "vorbehalten",
)

#: Words too common to choose a keyword by.
_COMMON = frozenset("the this of to a an and or in under license licence licensed software version v by is for as with any".split())

Node = tuple  # ("lit", text) | ("gap",) | ("alt", [sequence, ...], optional)


def parse(pattern: str) -> list[Node]:
    """A rule's regex as a sequence of literals, gaps and groups."""
    pattern = re.sub(r"([a-z]+) \?([a-z]+)", r"(?:\1 \2|\1\2)", pattern)
    pattern = re.sub(r"([a-z]+)([a-z])\?", r"(?:\1\2|\1)", pattern)
    tokens = re.findall(r"\(\?:|\)\??|\||…|[^()|…?]+", pattern)
    if "".join(tokens) != pattern:
        raise ValueError(f"not a rule's regex: {pattern}")
    at = 0

    def alternatives() -> list[list[Node]]:
        nonlocal at
        found: list[list[Node]] = [[]]
        while at < len(tokens) and not tokens[at].startswith(")"):
            token = tokens[at]
            at += 1
            if token == "|":
                found.append([])
            elif token == "…":
                found[-1].append(("gap",))
            elif token == "(?:":
                inside = alternatives()
                found[-1].append(("alt", inside, tokens[at] == ")?"))
                at += 1
            else:
                found[-1].append(("lit", token))
        return found

    whole = alternatives()
    return whole[0] if len(whole) == 1 else [("alt", whole, False)]


def regex_of(sequence: list[Node], word=lambda w: w) -> str:
    """The regex of a parsed pattern, with each word as ``word`` gives it."""
    out = []
    for node in sequence:
        if node[0] == "lit":
            out.append(re.sub(r"[a-z0-9]+", lambda m: word(m[0]), node[1]))
        elif node[0] == "gap":
            out.append(f"(?: [^ ]+){{0,{GAP}}}")
        else:
            out.append("(?:" + "|".join(regex_of(s, word) for s in node[1]) + ")" + "?" * node[2])
    return "".join(out)


def mandatory(sequence: list[Node]) -> list[tuple[str, ...]]:
    """Every tuple of literals of which each match holds one, as whole words."""
    found = []
    for node in sequence:
        if node[0] == "lit" and node[1].strip():
            found.append((node[1].strip(),))
        elif node[0] == "alt" and not node[2]:
            each = [mandatory(s) for s in node[1]]
            if all(each):
                found.append(tuple(dict.fromkeys(k for m in each for k in best(m))))
    return found


def _weight(literals: tuple[str, ...]) -> tuple[int, int]:
    return min(sum(len(w) for w in k.split() if w not in _COMMON) for k in literals), -len(literals)


def best(choices: list[tuple[str, ...]]) -> tuple[str, ...]:
    """The most telling of some tuples of literals."""
    return max(choices, key=_weight)


def gated(sequence: list[Node]) -> bool:
    """Whether the gate lets every text through that the parsed pattern matches."""
    return any(
        any(g in f" {node[1].strip()} " for g in GATE) if node[0] == "lit" else node[0] == "alt" and not node[2] and all(map(gated, node[1]))
        for node in sequence
    )


def expansions(sequence: list[Node], most: int = 400) -> list[str]:
    """Texts that the pattern matches, with every alternative of every group in one at
    least: all of them if they are no more than ``most``."""
    if not sequence:
        return [""]
    head, rest = sequence[0], expansions(sequence[1:], most)
    if head[0] == "lit":
        first = [head[1]]
    elif head[0] == "gap":
        first = ["", " one two"]
    else:
        first = [e for s in head[1] for e in expansions(s, most)] + [""] * head[2]
    if len(first) * len(rest) <= most:
        return [a + b for a in first for b in rest]
    return list(dict.fromkeys([a + rest[i % len(rest)] for i, a in enumerate(first)] + [first[i % len(first)] + b for i, b in enumerate(rest)]))


def _any_version(name: str) -> str:
    """``name`` that also takes a version written in one word with its v."""
    return re.sub(r"\(\?:version \|v \)\?(\d+|\(\?:1 3\|1 3c\))", lambda m: f"(?:(?:version |v )?{m[1]}|{'(?:v1 3|v1 3c)' if m[1][0] == '(' else 'v' + m[1]})", name)


def _titled(name: str) -> str:
    """``name`` and the word license, which may go without saying after a name that holds it."""
    if "(?: license)?" in name:
        spellings = [name.replace("(?: license)?", " license"), name.replace("(?: license)?", "")]
    else:
        spellings = name[3:-1].split("|") if re.fullmatch(r"\(\?:[^()]+\)", name) else [name]
    return "(?:" + "|".join(s + "(?: (?:license|licence))" + ("?" if "licen" in s else "") for s in spellings) + ")"


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority, each with its keywords; raises if the gate could
    stop a text that a rule matches."""
    written = [*PERMISSIVE, *RECIPROCAL, *EXCEPTIONS, *CONTENT, *RESTRICTED, *NOTICES]
    written += [(2, label, words) for label, words in ADDRESSES]
    written += [(1, label, f"spdx license identifier… with {words}") for label, words in SPDX_EXCEPTIONS]
    built = [
        (priority, label.removesuffix("-short"), template.format(l=_titled(name), i=spdx, e=f"(?:{name}|{spdx})"))
        for priority, template in TEMPLATES
        for label, name, spdx in ((a, _any_version(b), c) for a, b, c in FAMILIES)
    ]
    stopped = [p for p in [*(r[2] for r in built + written), *(p for p, _ in BASE)] if not gated(parse(p))]
    if stopped:
        raise ValueError(f"the gate could stop texts that these match: {stopped}")
    return tuple(sorted((Rule(priority, label, pattern, best(mandatory(parse(pattern)))) for priority, label, pattern in built + written), key=lambda r: r.priority))
