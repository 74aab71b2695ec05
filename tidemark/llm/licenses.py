"""License scans with DataFrame functions only.

Ordered signature rules: some four hundred regular expressions over a text's words, each with a label and a priority. Nearly all
are written by hand: sentences of license texts, notices, addresses and names; the names give three more forms each (stated,
named, SPDX header). Every rule is gated by parts of words that each match of its expression holds, read from the expression
itself: one is looked for in the raw text (few such gates serve all rules), one in its words. So line ends, hyphens and variants of
spelling lose no match, and a text without any gate, nearly all, costs a few substring searches. Of the detections of a text,
those that lie within another of the same or a higher priority are suppressed; the base phrases are reported beside, whether
suppressed or not.

A text's words are the runs of digits, letters a to z (after lower-casing A to Z) and characters beyond ASCII. The rules see them
with one space around each. Null texts are empty. Repeated rows get the same result. Other columns are ignored, whatever their
names. An empty table gives an empty result.

Very long texts: a text is one value in one task. Unbounded repeats are possessive, so that the regex engine neither recurses nor
tries ways again, and the work is linear in the text and in its detections (prefix sums go in two levels); memory is some ten times
the text while one of its rules is tried.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EXACT, NAMED, HINT = 3, 2, 1
#: What a detection of each priority says for a licence being stated.
WEIGHT = {EXACT: 0.95, NAMED: 0.8, HINT: 0.4}
#: Elements that one step of a prefix sum goes through.
CHUNK = 256


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: str  # over words with single spaces
    base: bool = False
    keyword: str = ""  # gates the rule in the lower-cased text
    name: str = ""  # gates the rule in the text's words


#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Parts of words to gate rules by in the raw text, where a rule has them; other rules are gated by their longest part.
GATES = ("spdx", "licen", "copyright", "creative", "warrant", "redistribut", "permission", "permitted", "proprietary", "reserved", "prohibited", "trademark", "patent", "domain", "liab", "gnu", "mozilla", "eclipse", "apache", "opensource", "confidential", "commercial")

#: Words of ordinary prose, by which a rule is gated only if it has no other part.
ORDINARY = frozenset("and any are as at be by common distribute do for free from general in information is it just library may not of only open or provided public reference server software terms that the think this to under use used want what with without work you your".split())

#: Licence names: label, the name as an expression, the identifier used in file headers.
NAMES = [
    ("mit", r"mit(?: x11| expat)?", "mit"),
    ("apache-2.0", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? 1 1", "apache 1 1"),
    ("bsd-2-clause", r"(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", r"(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)", "bsd 3 clause"),
    ("bsd-4-clause", r"(?:4 clause bsd|bsd 4 clause|original bsd)", "bsd 4 clause"),
    ("bsd", r"bsd(?: style)?", "bsd"),
    ("0bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd"),
    ("gpl-2.0", r"gpl(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", r"gpl(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl", r"(?:gnu )?general public", "gpl"),
    ("gpl-2.0", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: 0)?", "gplv2"),
    ("gpl-3.0", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?", "gplv3"),
    ("lgpl", r"(?:gnu )?lesser general public", "lgpl"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[cs]e(?: version| v) ?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public licen[cs]e(?: version| v) ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", r"(?:gnu )?library general public", "lgpl 2 0"),
    ("agpl-3.0", r"(?:gnu )?affero general public(?: licen[cs]e)?(?:(?: version| v) ?3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", r"(?:gnu )?free documentation", "gfdl 1 [123](?: only| or later)?"),
    ("mpl-1.1", r"mozilla public licen[cs]e(?: version| v)? 1 1", "mpl 1 1"),
    ("mpl-2.0", r"mozilla public(?: licen[cs]e)?(?:(?: version| v)? 2 0)?", "mpl 2 0"),
    ("epl-1.0", r"eclipse public licen[cs]e(?: version| v)? 1 0", "epl 1 0"),
    ("epl-2.0", r"eclipse public(?: licen[cs]e)?(?:(?: version| v)? 2 0)?", "epl 2 0"),
    ("edl-1.0", r"eclipse distribution", "edl 1 0"),
    ("cddl-1.0", r"common development and distribution", "cddl 1 [01]"),
    ("cpl-1.0", r"common public", "cpl 1 0"),
    ("ipl-1.0", r"ibm public", "ipl 1 0"),
    ("eupl-1.2", r"european union public", "eupl 1 [012]"),
    ("cecill-2.1", r"cecill", "cecill 2 1"),
    ("artistic-2.0", r"(?:perl )?artistic(?: licen[cs]e)?(?: 2(?: 0)?)?", "artistic 2 0"),
    ("isc", r"isc", "isc"),
    ("zlib", r"zlib(?: libpng)?", "zlib"),
    ("libpng", r"libpng", "libpng 2 0"),
    ("boost-1.0", r"boost software", "bsl 1 0"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"wtfpl", "wtfpl"),
    ("psf-2.0", r"python software foundation", "psf 2 0"),
    ("php-3.01", r"php", "php 3 01"),
    ("ruby", r"ruby", "ruby"),
    ("openssl", r"openssl", "openssl"),
    ("postgresql", r"postgresql", "postgresql"),
    ("w3c", r"w3c(?: software)?", "w3c"),
    ("ofl-1.1", r"(?:sil )?open font", "ofl 1 1"),
    ("odbl-1.0", r"open (?:data commons open )?database", "odbl 1 0"),
    ("pddl-1.0", r"public domain dedication and", "pddl 1 0"),
    ("ms-pl", r"microsoft public", "ms pl"),
    ("ms-rl", r"microsoft reciprocal", "ms rl"),
    ("afl-3.0", r"academic free", "afl 3 0"),
    ("osl-3.0", r"open software", "osl 3 0"),
    ("upl-1.0", r"universal permissive", "upl 1 0"),
    ("bsl-1.1", r"business source", "busl 1 1"),
    ("sspl-1.0", r"server side public", "sspl 1 0"),
    ("elastic-2.0", r"elastic", "elastic 2 0"),
    ("cc0-1.0", r"cc0(?: 1 0)?", "cc0 1 0"),
    ("cc-by-sa", r"cc by sa(?: [234] [05])?", "cc by sa 4 0"),
    ("cc-by-nc", r"cc by nc(?: [234] [05])?", "cc by nc 4 0"),
    ("cc-by-nd", r"cc by nd(?: [234] [05])?", "cc by nd 4 0"),
    ("cc-by-nc-sa", r"cc by nc sa(?: [234] [05])?", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", r"cc by nc nd(?: [234] [05])?", "cc by nc nd 4 0"),
    ("cc-by", r"creative commons attribution(?: [234] [05])?", "cc by [1234] [05]"),
    ("cc-by-sa", r"creative commons attribution share ?alike(?: [234] [05])?", "cc by sa [123] [05]"),
    ("cc-by-nc", r"creative commons attribution non ?commercial(?: [234] [05])?", "cc by nc [123] [05]"),
]

#: Signatures by family: label, priority, expression.
SIGNATURES = [
    # MIT, ISC and older permissive texts
    ("mit", EXACT, r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?"),
    ("mit", EXACT, r"without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", EXACT, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", EXACT, r"(?:www )?opensource org licenses mit(?: license)?(?: php| html)?"),
    ("mit", NAMED, r"(?:use of this source code is )?governed by an? mit style licen[cs]e"),
    ("mit", NAMED, r"under the terms of the mit licen[cs]e"),
    ("mit-0", EXACT, r"mit no attribution"),
    ("mit-x11", EXACT, r"except as contained in this notice the names? of (?:the |an? )?(?:\S+ ){1,6}shall not be used in advertising or otherwise to promote the sale"),
    ("isc", EXACT, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", EXACT, r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("0bsd", EXACT, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("curl", EXACT, r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("hpnd", EXACT, r"permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and)?(?: is hereby granted)? without fee"),
    ("ntp", EXACT, r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("postgresql", EXACT, r"without fee and without a written agreement is hereby granted"),
    ("unicode", EXACT, r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("json", EXACT, r"the software shall be used for good not evil"),
    ("beerware", EXACT, r"(?:if we meet some day and )?you think this stuff is worth it you can buy me a beer"),
    ("beerware", NAMED, r"(?:the )?beer ?ware licen[cs]e"),
    ("fsfap", EXACT, r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("x11", NAMED, r"x11 licen[cs]e"),
    ("dual-licensed", EXACT, r"dual licensed under the mit (?:and|or) gpl(?: version 2)? licenses?"),
    # BSD
    ("bsd", EXACT, r"redistributions? and use in source and binary forms with or without modification are permitted"),
    ("bsd", NAMED, r"redistributions of source code must retain the above copyright notice"),
    ("bsd", NAMED, r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", NAMED, r"this software is provided by (?:the )?(?:copyright holders?|regents|authors?|author s)(?: and contributors)? as is and any express or implied warranties"),
    ("bsd", NAMED, r"(?:use of this source code is )?governed by a bsd style licen[cs]e"),
    ("bsd", NAMED, r"(?:www )?opensource org licenses bsd license(?: php)?"),
    ("bsd-2-clause", EXACT, r"(?:www )?opensource org licenses bsd 2 clause"),
    ("bsd-2-clause", NAMED, r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause", EXACT, r"(?:www )?opensource org licenses bsd 3 clause"),
    ("bsd-3-clause", EXACT, r"neither the names? of (?:\S+ ){1,8}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-3-clause", NAMED, r"names? of (?:its|the|any) (?:authors?|contributors?|copyright holders?) may not be used to endorse or promote products"),
    ("bsd-3-clause-clear", EXACT, r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-4-clause", EXACT, r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    # Apache
    ("apache-2.0", EXACT, r"licensed under the apache license version 2 0(?: the license)?"),
    ("apache-2.0", EXACT, r"(?:www )?apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", EXACT, r"apache license version 2 0 january 2004"),
    ("apache-2.0", EXACT, r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", EXACT, r"licensed to the apache software foundation(?: asf)? under one or more contributor license agreements"),
    ("apache-2.0", EXACT, r"the asf licenses this file to you under the apache license"),
    ("apache-2.0", NAMED, r"see the notice file distributed with this work for additional information regarding copyright ownership"),
    ("apache-2.0", NAMED, r"(?:www )?opensource org licenses apache 2 0"),
    ("apache-1.1", EXACT, r"the names apache(?: server)? and apache (?:software foundation|group) must not be used to endorse or promote products"),
    ("apache-1.1", NAMED, r"alternate?ly this acknowledge?ment may appear in the software itself"),
    ("apache", NAMED, r"this product includes software developed (?:by|at) the apache (?:software foundation|group)"),
    ("llvm-exception", NAMED, r"apache license v2 0 with llvm exceptions?"),
    # GNU
    ("gpl", EXACT, r"this (?:program|library|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", EXACT, r"you should have received a copy of the gnu general public license along with"),
    ("gpl", NAMED, r"see the gnu general public license for more details"),
    ("gpl", EXACT, r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", EXACT, r"there is no warranty for the program to the extent permitted by applicable law"),
    ("gpl", NAMED, r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", NAMED, r"(?:www )?gnu org licenses(?: gpl(?: \d \d)?(?: html)?)?"),
    ("gpl", NAMED, r"(?:www )?gnu org copyleft(?: gpl)?(?: html)?"),
    ("gpl", NAMED, r"(?:free software foundation(?: inc)? )?51 franklin st(?:reet)?"),
    ("gpl", NAMED, r"(?:free software foundation(?: inc)? )?59 temple place"),
    ("gpl", NAMED, r"(?:free software foundation(?: inc)? )?675 mass(?:achusetts)? ave(?:nue)?"),
    ("gpl", HINT, r"free software foundation(?: inc)?"),
    ("gpl", HINT, r"gpl compatible"),
    ("gpl-2.0", EXACT, r"gnu general public license version 2 june 1991"),
    ("gpl-2.0", NAMED, r"either version 2 of the license or at your option any later version"),
    ("gpl-2.0", NAMED, r"gpl ?v ?2(?: only| or later)?"),
    ("gpl-3.0", EXACT, r"gnu general public license version 3 29 june 2007"),
    ("gpl-3.0", EXACT, r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", NAMED, r"either version 3 of the license or at your option any later version"),
    ("gpl-3.0", NAMED, r"gpl ?v ?3(?: only| or later)?"),
    ("gpl-exception", NAMED, r"as a special exception (?:\S+ ){0,10}permission to link"),
    ("gpl-exception", EXACT, r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-exception", NAMED, r"(?:gpl(?:v2)? with )?(?:the )?classpath exception"),
    ("gpl-exception", NAMED, r"gcc runtime library exception"),
    ("lgpl", EXACT, r"this (?:program|library|software) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", EXACT, r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("lgpl", NAMED, r"see the gnu (?:lesser|library) general public license for more details"),
    ("lgpl", EXACT, r"gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", EXACT, r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", EXACT, r"gnu lesser general public license version 3 29 june 2007"),
    ("lgpl", NAMED, r"lgpl ?v ?[23](?: 1| 0)?"),
    ("agpl-3.0", EXACT, r"gnu affero general public license version 3 19 november 2007"),
    ("agpl-3.0", EXACT, r"you should have received a copy of the gnu affero general public license"),
    ("agpl-3.0", NAMED, r"see the gnu affero general public license for more details"),
    ("agpl-3.0", NAMED, r"agpl ?v ?3"),
    ("gfdl", EXACT, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", NAMED, r"with no invariant sections no front cover texts and no back cover texts"),
    ("copyleft", HINT, r"copyleft"),
    # Weak copyleft
    ("mpl-2.0", EXACT, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", EXACT, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", NAMED, r"(?:www )?mozilla org mpl 2 0"),
    ("mpl-1.1", EXACT, r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", NAMED, r"(?:www )?mozilla org mpl mpl 1 1(?: html)?"),
    ("mpl-1.1", NAMED, r"alternatively the contents of this file may be used under the terms of (?:either )?the gnu"),
    ("npl-1.1", EXACT, r"the contents of this file are subject to the netscape public license"),
    ("cddl-1.0", EXACT, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl-1.0", NAMED, r"(?:usr src opensolaris license|opensolaris org os licensing)"),
    ("epl-1.0", EXACT, r"made available under the terms of the eclipse public license v ?1 0"),
    ("epl-2.0", EXACT, r"made available under the terms of the eclipse public license v ?2 0"),
    ("epl-1.0", NAMED, r"(?:www )?eclipse org legal epl v10(?: html)?"),
    ("epl-2.0", NAMED, r"(?:www )?eclipse org legal epl (?:v20|2 0)(?: html)?"),
    ("edl-1.0", NAMED, r"(?:www )?eclipse org org documents edl v10"),
    ("cpl-1.0", EXACT, r"made available under the terms of the common public license"),
    ("ipl-1.0", EXACT, r"the accompanying program is provided under the terms of this ibm public license"),
    ("eupl-1.2", EXACT, r"licensed under the eupl(?: version)?(?: 1 [12])?"),
    ("eupl-1.2", NAMED, r"joinup ec europa eu (?:software page |collection )?eupl"),
    ("cecill-2.1", EXACT, r"this software is governed by the cecill(?: [abc])? license under french law"),
    ("artistic-1.0", EXACT, r"you (?:can|may) redistribute it and or modify it under the same terms as perl(?: itself)?"),
    ("artistic-2.0", EXACT, r"the artistic license 2 0 copyright c 2000 2006 the perl foundation"),
    ("ms-pl", EXACT, r"this license governs use of the accompanying software if you use the software you accept this license"),
    # Others for software
    ("zlib", EXACT, r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", EXACT, r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", EXACT, r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("libpng", EXACT, r"the png reference library is supplied as is"),
    ("boost-1.0", EXACT, r"distributed under the boost software license version 1 0"),
    ("boost-1.0", EXACT, r"obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost-1.0", NAMED, r"(?:www )?boost org license 1 0 txt"),
    ("unlicense", EXACT, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", EXACT, r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", NAMED, r"(?:www )?unlicense org"),
    ("wtfpl", EXACT, r"do what the fuck you want to public licen[cs]e"),
    ("wtfpl", EXACT, r"you just do what the fuck you want to"),
    ("wtfpl", EXACT, r"verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("wtfpl", NAMED, r"(?:www )?wtfpl net"),
    ("psf-2.0", EXACT, r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("psf-2.0", EXACT, r"python software foundation license version 2"),
    ("php-3.01", EXACT, r"this source file is subject to version [23] \d\d? ?of the php license"),
    ("php-3.01", NAMED, r"(?:www )?php net license 3 \d\d? ?txt"),
    ("ruby", EXACT, r"you may redistribute it and or modify it under the same terms as ruby"),
    ("openssl", EXACT, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", EXACT, r"this product includes cryptographic software written by eric young"),
    ("w3c", EXACT, r"this work is being provided by the copyright holders under the following license"),
    ("w3c", NAMED, r"(?:www )?w3 org consortium legal"),
    ("afl-3.0", EXACT, r"licensed under the academic free license version [123] [01]"),
    ("osl-3.0", EXACT, r"licensed under the open software license version 3 0"),
    ("upl-1.0", EXACT, r"the universal permissive license upl version 1 0"),
    ("icu", NAMED, r"icu license icu 1 8 1 and later"),
    ("vim", NAMED, r"vim licen[cs]e"),
    ("sleepycat", EXACT, r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("tcl", EXACT, r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    ("imagemagick", NAMED, r"(?:www )?imagemagick org script license php"),
    ("clarified-artistic", NAMED, r"clarified artistic licen[cs]e"),
    ("naist", NAMED, r"use reproduction and distribution of this software is permitted"),
    ("qpl", NAMED, r"q public licen[cs]e"),
    ("sun-rpc", EXACT, r"sun rpc is a product of sun microsystems inc and is provided for unrestricted use"),
    # Source-available
    ("bsl-1.1", EXACT, r"business source license 1 1"),
    ("bsl-1.1", NAMED, r"change date (?:\S+ ){0,8}change license"),
    ("sspl-1.0", EXACT, r"server side public license version 1 october 16 2018"),
    ("elastic-2.0", EXACT, r"you may not provide the software to third parties as a hosted or managed service"),
    ("elastic-2.0", NAMED, r"elastic license(?: version| v)? 2(?: 0)?"),
    ("commons-clause", EXACT, r"commons clause license condition v1 0"),
    ("commons-clause", EXACT, r"the license does not (?:grant|include)(?: to you)? the right to sell the software"),
    ("polyform", EXACT, r"polyform (?:noncommercial|small business|shield|perimeter|strict|free trial) licen[cs]e"),
    ("confluent", NAMED, r"confluent community licen[cs]e"),
    ("redis-sal", NAMED, r"redis source available licen[cs]e"),
    # Models
    ("openrail", EXACT, r"(?:bigscience|creativeml|bigcode) (?:big ?code )?open ?rail(?: m)?(?: licen[cs]e)?"),
    ("openrail", NAMED, r"use based restrictions as referenced in (?:attachment|paragraph|exhibit)"),
    ("openrail", NAMED, r"responsible ai licen[cs]es?"),
    ("llama", EXACT, r"llama [234](?: \d)? community licen[cs]e(?: agreement)?"),
    ("gemma", EXACT, r"gemma terms of use"),
    # Creative Commons
    ("cc0-1.0", EXACT, r"creativecommons org publicdomain zero 1 0"),
    ("cc0-1.0", EXACT, r"cc0 1 0 universal"),
    ("cc0-1.0", EXACT, r"has waived all copyright and related or neighboring rights"),
    ("cc0-1.0", NAMED, r"creative commons zero"),
    ("cc0-1.0", EXACT, r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", EXACT, r"creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", EXACT, r"creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nc", EXACT, r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nd", EXACT, r"creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc-sa", EXACT, r"creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", EXACT, r"creativecommons org licenses by nc nd [1234] [05]"),
    ("cc-by", EXACT, r"licensed under a creative commons attribution(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-sa", EXACT, r"licensed under a creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-nc", EXACT, r"licensed under a creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-nd", EXACT, r"licensed under a creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-nc-sa", EXACT, r"licensed under a creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-nc-nd", EXACT, r"licensed under a creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-sa", NAMED, r"attribution share ?alike"),
    ("cc-by-nc-sa", NAMED, r"attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", NAMED, r"attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("creative-commons", HINT, r"creative commons(?: licen[cs]e)?"),
    # Data, fonts, documents and governments
    ("ofl-1.1", EXACT, r"this font software is licensed under the sil open font license(?: version 1 1)?"),
    ("ofl-1.1", EXACT, r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ofl-1.1", NAMED, r"scripts sil org ofl"),
    ("odbl-1.0", EXACT, r"opendatacommons org licenses odbl"),
    ("odbl-1.0", NAMED, r"openstreetmap contributors"),
    ("pddl-1.0", EXACT, r"opendatacommons org licenses pddl"),
    ("odc-by", EXACT, r"opendatacommons org licenses by"),
    ("odc-by", NAMED, r"open data commons attribution licen[cs]e"),
    ("cdla", NAMED, r"community data licen[cs]e agreement(?: permissive| sharing)?"),
    ("ogl", EXACT, r"contains public sector information licensed under the open government licen[cs]e"),
    ("ogl", NAMED, r"open government licen[cs]e(?: v ?[123](?: 0)?)?"),
    ("etalab", NAMED, r"(?:etalab open licen[cs]e|licence ouverte)"),
    ("dl-de", NAMED, r"datenlizenz deutschland"),
    ("fal", NAMED, r"(?:free art licen[cs]e|licence art libre)"),
    ("gutenberg", EXACT, r"this ebook is for the use of anyone anywhere (?:\S+ ){0,14}at no cost and with almost no restrictions whatsoever"),
    ("gutenberg", NAMED, r"project gutenberg(?: tm)? licen[cs]e"),
    ("crown-copyright", NAMED, r"crown copyright"),
    # Public domain
    ("public-domain", EXACT, r"(?:released|placed|dedicated|put) (?:in ?to|in|to) the public domain"),
    ("public-domain", NAMED, r"(?:is|are) (?:in|part of) the public domain"),
    ("public-domain", HINT, r"public domain"),
    ("public-domain", EXACT, r"not subject to copyright(?: protection)? in the united states"),
    ("public-domain", NAMED, r"works? of the (?:u s|us|united states)(?: federal)? government"),
    ("public-domain", NAMED, r"no known copyright restrictions"),
    ("public-domain", NAMED, r"copyright has expired"),
    ("public-domain", NAMED, r"(?:is|are) not copyrighted"),
    ("public-domain", NAMED, r"gemeinfrei"),
    ("public-domain", NAMED, r"domaine public"),
    ("public-domain", NAMED, r"dominio p.blico"),
    # Copyright lines
    ("copyright", NAMED, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*+"),
    ("copyright", NAMED, r"(?:c|©) (?:19|20)\d\d(?: (?:19|20)\d\d)*+ (?:\S+ ){1,4}all rights reserved"),
    ("copyright", NAMED, r"copyright ©(?: (?:19|20)\d\d)*+"),
    ("copyright", HINT, r"copyright(?: c)? (?:by|of|holders?|owners?|notice)"),
    ("copyright", HINT, r"copyrighted(?: material| work| content)?"),
    ("copyright", NAMED, r"this (?:\S+ )?is (?:protected by|subject to) copyright"),
    ("copyright", NAMED, r"urheberrechtlich gesch.tzt"),
    ("reserved", NAMED, r"(?:all|some|no) rights? reserved(?: worldwide)?"),
    ("reserved", NAMED, r"todos los derechos reservados"),
    ("reserved", NAMED, r"alle rechte vorbehalten"),
    ("reserved", NAMED, r"tous droits r.serv.s"),
    ("reserved", NAMED, r"tutti i diritti riservati"),
    ("reserved", NAMED, r"todos os direitos reservados"),
    # Warranty and liability
    ("warranty-disclaimer", HINT, r"without (?:any )?warrant(?:y|ies)(?: of any kind)?"),
    ("warranty-disclaimer", HINT, r"implied warrant(?:y|ies) of merchantability(?: (?:and|or) fitness for a particular purpose)?"),
    ("warranty-disclaimer", NAMED, r"in no event (?:shall|will) (?:the )?(?:(?:authors?|copyright|holders?|owners?|contributors?|regents|or) )++be (?:held )?liable"),
    ("warranty-disclaimer", NAMED, r"even if advised of the possibility of such damages?"),
    ("warranty-disclaimer", NAMED, r"merchantability fitness for a particular purpose and non ?infringement"),
    ("warranty-disclaimer", HINT, r"(?:software|information|content|service) is provided as is"),
    ("warranty-disclaimer", HINT, r"disclaims? (?:any|all)(?: and all)? (?:liability|warrant(?:y|ies))"),
    ("warranty-disclaimer", HINT, r"use (?:it |this )?at your own risk"),
    # Proprietary texts and terms
    ("proprietary", NAMED, r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", EXACT, r"unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: (?:copying|use|reproduction|or|and|distribution))*+(?: of this (?:file|document|software|work))?(?: via any medium)? is strictly prohibited"),
    ("proprietary", HINT, r"(?:may not|no part of (?:\S+ ){1,6}may) be reproduced(?: (?:\S+ ){0,8}without (?:the )?(?:prior )?(?:written )?permission)?"),
    ("proprietary", NAMED, r"(?:contains|is) (?:the )?(?:confidential|proprietary)(?: and (?:confidential|proprietary))? information"),
    ("proprietary", NAMED, r"for internal use only"),
    ("proprietary", NAMED, r"company confidential"),
    ("proprietary", HINT, r"trade secrets?(?: of)?"),
    ("proprietary", NAMED, r"all content(?: on this (?:site|website|page))? is the (?:exclusive )?property of"),
    ("no-redistribution", EXACT, r"redistribution(?: (?:or|and) (?:use|reproduction))? (?:is )?(?:strictly )?(?:prohibited|forbidden|not permitted)"),
    ("no-redistribution", NAMED, r"not for redistribution"),
    ("no-redistribution", NAMED, r"you may not (?:copy|reproduce|distribute|modify) (?:\S+ ){0,6}without permission"),
    ("permission-required", NAMED, r"without (?:the )?(?:express |prior )?(?:express |prior )?written (?:permission|consent)(?: of the (?:publisher|author|copyright (?:holder|owner)))?"),
    ("permission-required", NAMED, r"re ?printed (?:with|by) permission"),
    ("permission-required", HINT, r"used (?:with|by) permission"),
    ("eula", NAMED, r"end user licen[cs]e agreement"),
    ("eula", EXACT, r"reverse engineer decompile or disassemble"),
    ("eula", NAMED, r"you (?:\S+ ){0,6}agree to (?:be bound by )?the(?:se)? terms"),
    ("eula", NAMED, r"licen[cs]e agreement between you and"),
    ("eula", HINT, r"(?:for )?evaluation purposes only"),
    ("non-commercial", EXACT, r"commercial use (?:is )?(?:strictly )?(?:prohibited|forbidden|not (?:allowed|permitted))"),
    ("non-commercial", NAMED, r"(?:for )?(?:personal|academic|research|educational)(?: (?:and|or))?(?: (?:personal|academic|research|educational))? (?:and )?non ?commercial use only"),
    ("non-commercial", NAMED, r"for non ?commercial (?:use|purposes) only"),
    ("non-commercial", NAMED, r"for academic(?: (?:and|or) research)? (?:use|purposes) only"),
    ("non-commercial", NAMED, r"for research(?: (?:and|or) educational)? (?:use|purposes) only"),
    ("non-commercial", NAMED, r"for educational(?: (?:and|or) research)? (?:use|purposes) only"),
    ("non-commercial", HINT, r"not (?:be used )?for commercial (?:use|purposes)"),
    ("freeware", NAMED, r"(?:this (?:program|software) is )?freeware"),
    ("freeware", NAMED, r"free for (?:personal and )?(?:non ?)?commercial use"),
    ("freeware", NAMED, r"free for personal use"),
    ("shareware", NAMED, r"shareware"),
    ("terms", HINT, r"terms and conditions of use"),
    ("terms", HINT, r"terms of service"),
    ("trademark", HINT, r"(?:registered )?trademarks? of"),
    ("trademark", NAMED, r"trademarks are (?:the )?property of their respective owners"),
    ("patent", HINT, r"patents? pending"),
    ("patent", HINT, r"(?:u s|us|united states) patents? (?:no|nos|numbers?)"),
    ("patent", NAMED, r"grant of patent licen[cs]e"),
    # References
    ("dual-licensed", HINT, r"dual(?:ly)? licen[cs]ed"),
    ("license-reference", HINT, r"see (?:the )?(?:accompanying )?licen[cs]e(?: file)?(?: for (?:more )?(?:details|information|terms))?"),
    ("license-reference", HINT, r"you should have received a copy of the (?:\S+ ){0,6}licen[cs]e"),
    ("license-reference", HINT, r"subject to the (?:terms|following licen[cs]e)(?: and conditions)?(?: of (?:the|this) licen[cs]e)?"),
    ("license-reference", NAMED, r"you may not use this file except in compliance with the licen[cs]e"),
    ("license-reference", NAMED, r"this (?:project|software|work|package|code) is licen[cs]ed under the terms of"),
    ("license-reference", HINT, r"(?:that can be )?found in the licen[cs]e file"),
    ("license-reference", HINT, r"licen[cs]e file in the (?:project |top level )?root"),
    ("license-reference", HINT, r"you may obtain a copy of the licen[cs]e at"),
    ("license-reference", NAMED, r"hereby publish it under the following licen[cs]e"),
    ("license-reference", HINT, r"see (?:the )?copying(?: file)? for (?:more )?(?:details|information)"),
    ("open-source", HINT, r"(?:an? )?open source licen[cs]e"),
    ("open-source", HINT, r"osi approved(?: licen[cs]e)?"),
    ("open-source", HINT, r"open source initiative"),
    ("open-source", HINT, r"permissive(?:ly)? licen[cs]ed?"),
]


def rules() -> list[Rule]:
    """All rules in their order: base phrases, signatures, and for each name the forms in which licences are stated."""
    found = [Rule(label, NAMED, phrase, True) for phrase, label in BASE.items()]
    found += [Rule(*s) for s in SIGNATURES]
    for label, name, identifier in NAMES:
        found.append(Rule(label, EXACT, rf"(?:released|distributed|available|published|provided|licen[cs]ed) under (?:the )?(?:terms of (?:the )?)?(?:a )?{name}(?: licen[cs]e)?"))
        found.append(Rule(label, NAMED, rf"(?:(?:the )?{name} licen[cs]e|licen[cs]e (?:type |name |is )?(?:the )?{name})"))
        found.append(Rule(label, EXACT, rf"spdx license identifier {identifier}"))
    return found


def held_parts(parsed: list) -> list[str]:
    """Parts of words that every match of a parsed expression holds. Of alternatives, the parts that each of them holds."""
    runs, run = [], ""
    for op, value in [*parsed, (None, None)]:
        if op is sre.LITERAL:
            run += chr(value)
            continue
        runs += re.split(SEPARATORS, run)
        run = ""
        if op is sre.SUBPATTERN:
            runs += held_parts(value[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0] > 0:
            runs += held_parts(value[2])
        elif op is sre.BRANCH:
            ways = [held_parts(way) for way in value[1]]
            runs += [part for part in dict.fromkeys(sum(ways, [])) if all(any(part in other for other in way) for way in ways)]
    return [part for part in runs if part]


def gated(rule: Rule) -> Rule:
    """The rule with gates that every match holds: in the raw text the first of GATES that fits, else the longest part of its
    expression that isn't an ordinary word; in the words the longest other part."""
    parts = sorted(dict.fromkeys(held_parts(_parser.parse(rule.pattern))), key=lambda part: (part in ORDINARY, -len(part)))
    keyword = next((g for g in GATES if any(g in part for part in parts)), next(iter(parts), ""))
    name = next((part for part in parts if keyword not in part), keyword)
    return replace(rule, keyword=keyword, name=name)


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def preceding(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each element of the array, all elements before it joined. Goes in two levels, by chunks, so that the arrays that a step
    copies stay short."""
    def scan(items: Column, begin: Column) -> Column:
        held = F.struct(begin.alias("sum"), F.slice(F.array(begin), 1, 0).alias("out"))
        step = lambda h, x: F.struct(join(h["sum"], x).alias("sum"), F.concat(h["out"], F.array(h["sum"])).alias("out"))
        return F.aggregate(items, held, step)["out"]

    def by_chunks(values: Column) -> Column:
        last = F.greatest(F.ceil(F.size(values) / F.lit(CHUNK)).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda k: F.slice(values, (k - 1) * CHUNK + 1, F.lit(CHUNK)))

    def joined(chunks: Column) -> Column:
        begins = scan(F.transform(chunks, lambda c: F.aggregate(c, zero, join)), zero)
        return bound(begins, lambda b: F.flatten(F.transform(chunks, lambda c, n: scan(c, F.get(b, n)))))

    return bound(bound(values, by_chunks), joined)


PLACE = "struct<start:int,ending:int,rank:int,label:string,base:boolean>"


def places(words: Column, rule: Column) -> Column:
    """The rule's matches as array of (start, minus end, minus priority, label, base); start and end count words from 0."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    hits = F.transform(F.regexp_extract_all(words, pattern, F.lit(0)), spaces)
    gaps = F.transform(F.split(words, pattern, -1), spaces)
    # of each match the spaces before it, from the end of the last one, and those in it
    pairs = bound(gaps, lambda gap: F.transform(hits, lambda hit, n: F.struct(F.get(gap, n).alias("gap"), hit.alias("hit"))))

    def placed(pairs: Column) -> Column:
        before = preceding(F.transform(pairs, lambda p: p["gap"] + p["hit"]), F.lit(0), lambda x, y: x + y)

        def place(p: Column, before: Column) -> Column:
            start = before + p["gap"] - 1
            return F.struct(start.alias("start"), (-(start + p["hit"])).alias("ending"), (-rule["priority"]).alias("rank"), rule["label"].alias("label"), rule["base"].alias("base"))

        return bound(before, lambda b: F.transform(pairs, lambda p, n: place(p, F.get(b, n))))

    return bound(pairs, placed)


def unsuppressed(found: Column) -> Column:
    """The detections, in order of (start, longest first, highest priority first), that no other of at least their priority holds.

    What holds a detection comes before it in this order, so it is enough to know how far those of each priority reach."""
    levels = (HINT, NAMED, EXACT)
    nothing = F.struct(*(F.lit(-1).alias(f"reach{p}") for p in levels))

    def stays(d: Column, reach: Column) -> Column:
        own = F.when(d["rank"] == -EXACT, reach[f"reach{EXACT}"]).when(d["rank"] == -NAMED, reach[f"reach{NAMED}"]).otherwise(reach[f"reach{HINT}"])
        return -d["ending"] > own

    def kept(ordered: Column) -> Column:
        # a detection reaches for every priority up to its own
        ends = F.transform(ordered, lambda d: F.struct(*(F.when(-d["rank"] >= p, -d["ending"]).otherwise(F.lit(-1)).alias(f"reach{p}") for p in levels)))
        reach = preceding(ends, nothing, lambda x, y: F.struct(*(F.greatest(x[f"reach{p}"], y[f"reach{p}"]).alias(f"reach{p}") for p in levels)))
        return bound(reach, lambda r: F.filter(ordered, lambda d, n: stays(d, F.get(r, n))))

    return bound(F.array_sort(found), kept)


def scan(docs: DataFrame, ruleset: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text", gates: bool = True) -> DataFrame:
    """The id, n_words, base (detections of the base phrases) and kept (all detections that aren't suppressed).

    Without ``gates`` every rule is tried on every text, with the same result."""
    ruleset = [gated(r) if gates else r for r in ruleset or rules()]
    keywords = list(dict.fromkeys(r.keyword for r in ruleset))
    # the rules as one literal, which is parsed once for a plan
    rows = json.dumps([{"keyword": r.keyword, "name": r.name, "priority": r.priority, "label": r.label, "pattern": r.pattern, "base": r.base} for r in ruleset])
    table = F.from_json(F.lit(rows), "array<struct<keyword:string,name:string,priority:int,label:string,pattern:string,base:boolean>>")
    found = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # lower-casing other letters too can only add keywords; the words themselves are exact
    found = found.select("id", F.trim(F.regexp_replace("text", BETWEEN, " ")).alias("spaced"), F.lower("text").alias("low"))
    keyed = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(k)), F.lit(k)) for k in keywords)))
    n_words = F.when(F.col("spaced") == "", 0).otherwise(spaces(F.col("spaced")) + 1).cast("long")
    found = found.select("id", "spaced", n_words.alias("n_words"), keyed.alias("keywords"))
    exact = F.when(F.octet_length("spaced") == F.length("spaced"), F.lower("spaced")).otherwise(F.translate("spaced", UPPER, LOWER))
    words = F.when(F.size("keywords") > 0, F.concat(F.lit(" "), exact, F.lit(" ")))
    found = found.select("id", "n_words", "keywords", words.alias("words"))
    tried = F.filter(table, lambda r: F.array_contains("keywords", r["keyword"]) & F.contains(F.col("words"), r["name"]) & F.regexp_like("words", F.concat(F.lit("(?<= )(?:"), r["pattern"], F.lit(")(?= )"))))
    none = F.array().cast(f"array<{PLACE}>")
    found = found.withColumn("found", F.coalesce(F.when(F.col("words").isNotNull(), F.flatten(F.transform(tried, lambda r: places(F.col("words"), r)))), none))
    return found.select(F.col("id").alias(id_col), "n_words", F.array_sort(F.filter("found", lambda d: d["base"])).alias("base"), F.when(F.size("found") > 0, unsuppressed(F.col("found"))).otherwise(none).alias("kept"))


def license_spans(docs: DataFrame, **arguments) -> DataFrame:
    """One row per kept detection: id, start_word, end_word, label, priority."""
    found = scan(docs, **arguments)
    key = quoted(found.columns[0])
    return found.select(key, F.explode("kept").alias("d")).select(key, F.col("d.start").alias("start_word"), (-F.col("d.ending")).alias("end_word"), "d.label", (-F.col("d.rank")).alias("priority"))


def licenses(docs: DataFrame, **arguments) -> DataFrame:
    """Per row: the id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = scan(docs, **arguments)
    starts = F.transform("base", lambda d: d["start"])
    names = lambda c: F.array_distinct(F.transform(c, lambda d: d["label"]))
    weight = F.create_map(*(F.lit(x) for p, w in WEIGHT.items() for x in (-p, w)))
    strongest = F.array_min(F.transform(F.concat("base", "kept"), lambda d: d["rank"]))
    return found.select(
        quoted(found.columns[0]),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(names("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(names("base"), names("kept"))), ",").alias("labels"),
        F.coalesce(F.try_element_at(weight, strongest), F.lit(0.0)).alias("score"),
    )
