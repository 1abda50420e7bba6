"""Signature rules for licence texts, notices, tags and links: (label, priority, keyword, pattern).

Priorities: 4 sentences of a licence's own text, 3 notices that grant a licence by name and version, 2 tags, links and
full names, 1 loose mentions. The keyword must occur in the text before the pattern is tried. Patterns see text with
A-Z lowered; a space in them stands for any run of white space and comment marks.
"""

from __future__ import annotations

TEXTS = [
    ("mit", "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "furnished", r"to permit persons to whom the software is furnished to do so, subject to the following conditions"),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", "permission", r"permission is hereby granted, free of charge[^.]{0,300}to permit persons to whom the software is furnished to do so\."),
    ("mit-modern-variant", "permission", r"permission is hereby granted, without written agreement and without license or royalty fees"),
    ("x11", "advertising", r"except as contained in this notice, the name of[^.]{1,80}shall not be used in advertising or otherwise to promote"),
    ("isc", "permission", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided"),
    ("0bsd", "permission", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\."),
    ("hpnd", "permission", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose[^.]{0,60}is hereby granted"),
    ("bsd-2-clause", "redistribution", r"redistributions? in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("bsd-2-clause", "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions"),
    ("bsd-3-clause", "endorse", r"(?:neither the names? of|the names? of)[^.]{1,120}(?:nor the names of its contributors )?may(?: not)? be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause-clear", "patent", r"no express or implied licenses to any party's patent rights are granted by this license"),
    ("apache-2.0", "patent", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable[^.]{0,60}patent license"),
    ("apache-2.0", "license", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "as is", r"distributed on an \"as is\" basis, without warranties or conditions of any kind"),
    ("apache-1.1", "redistribution", r"the end-user documentation included with the redistribution, if any, must include the following acknowledge?ment"),
    ("apache-1.0", "apache", r"redistributions of any form whatsoever must retain the following acknowledge?ment: \"this product includes software developed by the apache group"),
    ("gpl-2.0-or-later", "general public", r"either version 2 of the license, or \(at your option\) any later version"),
    ("gpl-3.0-or-later", "general public", r"either version 3 of the license, or \(at your option\) any later version"),
    ("gpl", "free software", r"this program is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu general public license"),
    ("gpl", "general public", r"you should have received a copy of the gnu general public license along with this"),
    ("gpl-2.0", "general public", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "general public", r"the gnu general public license is a free, copyleft license for software and other kinds of works"),
    ("lgpl", "lesser", r"under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation"),
    ("lgpl-2.1", "lesser", r"this license, the lesser general public license, applies to some specially designated software packages"),
    ("lgpl-3.0", "lesser", r"incorporates the terms and conditions of version 3 of the gnu general public license, supplemented by the additional permissions"),
    ("agpl-3.0", "affero", r"the gnu affero general public license is a free, copyleft license for software and other kinds of works"),
    ("agpl-3.0", "remote", r"prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "documentation", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license, v\. ?2\.0"),
    ("mpl-2.0", "mozilla", r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1\.1"),
    ("epl-1.0", "eclipse", r"the accompanying materials are made available under the terms of the eclipse public license v1\.0"),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public license v?\.? ?2\.0"),
    ("cddl-1.0", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", "boost", r"obtaining a copy of the software and accompanying documentation covered by this license \(the \"software\"\) to use, reproduce, display"),
    ("zlib", "warranty", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such, and must not be misrepresented"),
    ("libpng", "png", r"the png reference library is supplied \"as is\""),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "want to", r"you just do what the f[u*]ck you want to"),
    ("cc0-1.0", "waive", r"affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives"),
    ("cc0-1.0", "dedicat", r"has dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("artistic-1.0", "artistic", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "artistic", r"this license establishes the terms under which a given free software package may be copied, modified, distributed"),
    ("postgresql", "postgres", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement"),
    ("ncsa", "university", r"to deal with the software without restriction, including without limitation the rights to use, copy"),
    ("python-2.0", "python", r"psf hereby grants licensee a nonexclusive, royalty-free, world-wide license to reproduce, analyze, test"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license, version 1\.1"),
    ("unicode", "unicode", r"permission is hereby granted, free of charge, to any person obtaining a copy of the unicode data files"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", "permission", r"permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"),
    ("ms-pl", "microsoft", r"if you use the software, you accept this license\. if you do not accept the license, do not use the software"),
    ("sspl-1.0", "service source", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl-1.1", "change date", r"the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use"),
    ("elastic-2.0", "elastic", r"you may not provide the software to third parties as a hosted or managed service"),
    ("json", "good", r"the software shall be used for good, not evil"),
    ("beerware", "beer", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("eupl-1.2", "european union", r"licensed under the eupl, version 1\.2"),
    ("odbl-1.0", "database", r"this [^.]{1,80} is made available under the open database license"),
    ("openrail", "use-based", r"use-based restrictions as referenced in paragraph 5 must be included"),
    ("llama-community", "community license", r"is licensed under the llama \d(?:\.\d)? community license"),
    ("proprietary", "proprietary", r"this (?:software|document|file|work) (?:is|contains)[^.]{0,60}(?:proprietary|confidential)(?: and (?:proprietary|confidential))? (?:information|property|material)"),
    ("proprietary", "prior written", r"may not be (?:reproduced|copied|distributed|disclosed)[^.]{0,120}without[^.]{0,40}prior written (?:permission|consent)"),
]

GRANT = r"(?:licen[sc]ed|released|distributed|available|provided|published|covered|shared|dual-licen[sc]ed|redistributed)"
UNDER = GRANT + r"(?: \w+){0,3} under(?: the terms of)?(?: either)?(?: the| a| an)? "
NAMES = [
    ("mit", "mit", r"(?:mit|expat)(?:/x11)? licen[sc]e"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e,? (?:version |v\.? ?)?1\.1"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)3(?:\.0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)2(?:\.0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)1(?:\.0)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl[- ]?(?:version |v\.? ?)?3(?:\.0)?\b"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl[- ]?(?:version |v\.? ?)?2(?:\.0)?\b"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? (?:version |v\.? ?)3(?:\.0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? (?:version |v\.? ?)2\.1"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public licen[sc]e,? (?:version |v\.? ?)2(?:\.0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e(?:,? (?:version |v\.? ?)3(?:\.0)?)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? (?:version |v\.? ?)?1\.1"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e,? (?:- )?(?:version |v\.? ?)?2(?:\.0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e,? (?:- )?(?:version |v\.? ?)?1(?:\.0)?"),
    ("cddl-1.0", "common development", r"common development and distribution licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd[- ]2[- ]clause|2[- ]clause bsd|freebsd) licen[sc]e"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd[- ]3[- ]clause|3[- ]clause bsd) licen[sc]e"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd[- ]4[- ]clause|4[- ]clause bsd) licen[sc]e"),
    ("bsd", "bsd", r"bsd(?:[- ]style)? licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?:,? (?:version |v\.? ?)?1\.0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e(?:,? (?:version |v\.? ?)?1(?:\.0)?)?"),
    ("python-2.0", "python", r"(?:python software foundation|psf) licen[sc]e"),
    ("postgresql", "postgres", r"postgresql licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)? licen[sc]e"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?:,? (?:version |v\.? ?)?1\.2)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("odbl-1.0", "open database", r"open database licen[sc]e"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e"),
    ("pddl-1.0", "public domain dedication", r"(?:odc |open data commons )?public domain dedication and licen[sc]e"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e"),
    ("busl-1.1", "business source", r"business source licen[sc]e(?: 1\.1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: 2\.0)?"),
    ("openrail", "rail", r"(?:creativeml |bigscience )?open ?rail(?:\+\+)?-?m?(?: licen[sc]e)?"),
    ("llama-community", "llama", r"llama(?: \d(?:\.\d)?)? community licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e,? (?:version |v\.? ?)?3\.01"),
    ("ogl-3.0", "open government", r"open government licen[cs]e(?: v?3\.0)?"),
]
CREATIVE = [
    ("cc-by-nc-nd", r"(?:by-nc-nd|attribution[- ]non-?commercial[- ]no-?deriv(?:ative)?s(?:works)?)"),
    ("cc-by-nc-sa", r"(?:by-nc-sa|attribution[- ]non-?commercial[- ]share-?alike)"),
    ("cc-by-nc", r"(?:by-nc|attribution[- ]non-?commercial)"),
    ("cc-by-nd", r"(?:by-nd|attribution[- ]no-?deriv(?:ative)?s(?:works)?)"),
    ("cc-by-sa", r"(?:by-sa|attribution[- ]share-?alike)"),
    ("cc-by", r"(?:by|attribution)"),
]
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
LINKS = [
    ("mit", "opensource.org", r"opensource\.org/licenses?/mit(?:-license)?"),
    ("apache-2.0", "apache.org", r"apache\.org/licenses/license-2\.0"),
    ("apache-2.0", "opensource.org", r"opensource\.org/licenses?/apache-2\.0"),
    ("gpl-3.0", "gnu.org", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl-2.0", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl", "gnu.org", r"gnu\.org/(?:licenses|copyleft)/(?:gpl\b|$|\s|>|\.)"),
    ("lgpl-3.0", "gnu.org", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl-2.1", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("agpl-3.0", "gnu.org", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl", "gnu.org", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-1.1", "mozilla.org", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("epl-2.0", "eclipse.org", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("epl-1.0", "eclipse.org", r"eclipse\.org/legal/epl-v10"),
    ("bsd-2-clause", "opensource.org", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "opensource.org", r"opensource\.org/licenses?/bsd-3-clause"),
    ("isc", "opensource.org", r"opensource\.org/licenses?/isc"),
    ("zlib", "zlib.net", r"zlib\.net/zlib_license"),
    ("bsl-1.0", "boost.org", r"boost\.org/license_1_0"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("cc0-1.0", "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-pdm-1.0", "creativecommons", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("ofl-1.1", "scripts.sil.org", r"scripts\.sil\.org/ofl"),
    ("odbl-1.0", "opendatacommons", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", "opendatacommons", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", "opendatacommons", r"opendatacommons\.org/licenses/pddl"),
    ("ogl-3.0", "nationalarchives", r"nationalarchives\.gov\.uk/doc/open-government-licence"),
    ("eupl-1.2", "europa.eu", r"europa\.eu/[^\s]{0,80}eupl"),
    ("python-2.0", "python.org", r"python\.org/(?:psf/license|[\d.]+/license)"),
    ("artistic-2.0", "perlfoundation", r"perlfoundation\.org/artistic_license_2_0"),
    ("cddl-1.0", "cddl", r"opensource\.org/licenses?/cddl-1\.0"),
    ("busl-1.1", "mariadb", r"mariadb\.com/bsl11"),
    ("sspl-1.0", "mongodb", r"mongodb\.com/licensing/server-side-public-license"),
]
TAGGED = (
    "mit mit-0 x11 isc 0bsd bsd-2-clause bsd-3-clause bsd-4-clause bsd-3-clause-clear apache-1.0 apache-1.1 apache-2.0 "
    "gpl-1.0 gpl-2.0 gpl-3.0 lgpl-2.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-1.1 mpl-2.0 epl-1.0 epl-2.0 cddl-1.0 bsl-1.0 zlib libpng "
    "unlicense wtfpl cc0-1.0 artistic-1.0 artistic-2.0 postgresql ncsa python-2.0 ofl-1.1 openssl curl ms-pl ms-rl sspl-1.0 "
    "busl-1.1 elastic-2.0 json eupl-1.2 odbl-1.0 odc-by-1.0 pddl-1.0 hpnd beerware ruby vim php-3.01").split()
MENTIONS = [
    ("all-rights-reserved", "rights reserved", r"all rights (?:are )?reserved"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in)?to? ?the public domain"),
    ("public-domain", "public domain", r"(?:this work|this file|it) is in the public domain"),
    ("creative-commons", "creative commons", r"creative commons(?: \w+){0,3} licen[sc]e"),
    ("proprietary", "proprietary", r"proprietary licen[sc]e"),
    ("proprietary", "commercial", r"commercial licen[sc]e"),
    ("bsd", "bsd", r"bsd licen[sc]e"),
    ("mit", "mit", r"\bmit[- ]licen[sc]ed?"),
    ("apache", "apache", r"\bapache licen[sc]ed?"),
    ("gpl", "gpl", r"\bgpl(?:'?e?d)?(?: licen[sc]e| code|-licen[sc]ed)"),
    ("gpl", "public licen", r"general public licen[sc]e"),
]


def all_rules() -> list[tuple[str, int, str, str]]:
    """Every rule in its fixed order; the order breaks ties between equal detections."""
    rules = [(label, 4, keyword, pattern) for label, keyword, pattern in TEXTS]
    rules += [(label, 3, keyword, UNDER + pattern) for label, keyword, pattern in NAMES]
    rules += [(label, 2, keyword, r"\bthe " + pattern) for label, keyword, pattern in NAMES]
    for label, words in CREATIVE:
        for version in CREATIVE_VERSIONS:
            number = version.replace(".", r"\.")
            rules.append((f"{label}-{version}", 3, "cc", rf"\bcc[- ]{words}(?:[- ]|, ?)(?:version |v\.? ?)?{number}"))
            rules.append((f"{label}-{version}", 3, "creative commons", rf"creative commons {words}[- ](?:\w+ ){{0,2}}{number}"))
            if label != "cc-by":
                rules.append((f"{label}-{version}", 2, "creativecommons", rf"creativecommons\.org/licenses/{label[3:]}/{number}"))
        rules.append((label, 2, "cc", rf"\bcc[- ]{words}\b"))
    rules += [(f"cc-by-{version}", 2, "creativecommons", r"creativecommons\.org/licenses/by/" + version.replace(".", r"\."))
              for version in CREATIVE_VERSIONS]
    rules += [(label, 2, keyword, pattern) for label, keyword, pattern in LINKS]
    rules += [(label, 3, "spdx", r"spdx-license-identifier: ?(?:\(? ?[\w.+-]+ (?:or|and|with) )*" + label.replace(".", r"\.")
               + r"(?:-only|-or-later|\+)?(?:\b|$)") for label in TAGGED]
    rules += [(label, 1, keyword, pattern) for label, keyword, pattern in MENTIONS]
    return rules
