"""Licence scans by sentence-rule recognition.

Texts are cut into sentences, sentences are normalised (A-Z lowered, everything but letters and digits a space) and
looked up among known licence sentences. The sequence of their identifiers is matched against ordered licence rules.
Wrapped licence texts are read three times, with a line break as an end, as a space, and as a space without comment and list
marks; the reading that knows more sentences counts (the first, if equal). A sentence that isn't known as a whole is searched
for SPDX identifiers and for phrases that name a licence, which may stand behind any words but a negation. A rule that says
less than another one that fits (a BSD licence of no known kind, beside one of three clauses) gives way to it. Only built-in
functions are used, rows are independent, nothing is shuffled. ``scan_sql`` is the same in SQL, from the same tables.

Defined cases: a null or empty text has no sentences and no licences; repeated rows get equal results; a sentence that
occurs twice is in the sequence twice; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Identifier and normalised text of known licence sentences; several may have one identifier.
SENTENCES = [
    ("mit_release", "released under the mit license"),
    ("mit_licensed", "licensed under the mit license"),
    ("mit_title", "mit license"),
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as_is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache_licensed", "licensed under the apache license version 2 0"),
    ("apache_header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache_obtain", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl3_work", "this work is licensed under the gnu general public license version 3"),
    ("gpl3_program", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl_hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("ccbync_licensed", "licensed under cc by nc 4 0"),
    ("ccby_licensed", "licensed under cc by 4 0"),
    ("ccbysa_licensed", "licensed under cc by sa 4 0"),
    ("cc0_waived", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("public_domain", "this work is in the public domain"),
    ("bsd_redistribute", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("reserved", "all rights reserved"),
    ("mit_title", "the mit license"),
    ("mit_title", "the mit license mit"),
    ("mit_permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit_notice", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    ("apache_title", "apache license version 2 0 january 2004 http www apache org licenses"),
    ("gpl3_preamble", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl2_program", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl2_program", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl2_preamble", "by contrast the gnu general public license is intended to guarantee your freedom to share and change free software to make sure the software is free for all its users"),
    ("lgpl2_library", "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl21_library", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl21_preamble", "this license the lesser general public license applies to some specially designated software packages typically libraries of the free software foundation and other authors who decide to use it"),
    ("lgpl3_library", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl3_library", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl3_preamble", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below"),
    ("agpl3_program", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3_preamble", "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software"),
    ("mpl2_title", "mozilla public license version 2 0"),
    ("mpl2_subject", "this source code form is subject to the terms of the mozilla public license v"),  # "v. 2.0" is cut behind the v
    ("isc_title", "isc license"),
    ("isc_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc_grant", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense_free", "this is free and unencumbered software released into the public domain"),
    ("zlib_grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("boost_title", "boost software license version 1 0 august 17th 2003"),
    ("boost_grant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("mit0_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("mit0_title", "mit no attribution"),
    ("apache_licensed", "licensed under the apache license version 2 0 the license"),
    ("apache_obtain", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("apache_as_is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd_source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd_binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd_endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_endorse", "neither the name of copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_endorse", "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_endorse", "neither the name of the organization nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_endorse", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_endorse", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_advert", "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd_advert", "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by the organization"),
    ("gpl1_title", "gnu general public license version 1 february 1989"),
    ("gpl2_title", "gnu general public license version 2 june 1991"),
    ("gpl3_title", "gnu general public license version 3 29 june 2007"),
    ("lgpl2_title", "gnu library general public license version 2 june 1991"),
    ("lgpl21_title", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl3_title", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl3_title", "gnu affero general public license version 3 19 november 2007"),
    ("gfdl13_title", "gnu free documentation license version 1 3 3 november 2008"),
    ("gfdl13_document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version published by the free software foundation with no invariant sections no front cover texts and no back cover texts"),
    ("gpl_copy", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl_details", "see the gnu general public license for more details"),
    ("lgpl_details", "see the gnu lesser general public license for more details"),
    ("agpl_details", "see the gnu affero general public license for more details"),
    ("mpl11_subject", "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license"),
    ("mpl2_title", "mozilla public license 2 0"),
    ("epl1_title", "eclipse public license v 1 0"),
    ("epl2_title", "eclipse public license v 2 0"),
    ("eupl12_title", "european union public licence v 1 2"),
    ("cddl1_title", "common development and distribution license cddl version 1 0"),
    ("mspl_title", "microsoft public license ms pl"),
    ("psf2_title", "python software foundation license version 2"),
    ("artistic2_title", "the artistic license 2 0"),
    ("ofl11_title", "sil open font license version 1 1 26 february 2007"),
    ("ofl11_licensed", "this font software is licensed under the sil open font license version 1 1"),
    ("postgresql_grant", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("unlicense_anyone", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib_origin", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib_altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("wtfpl_title", "do what the fuck you want to public license"),
    ("wtfpl_copy", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("json_evil", "the software shall be used for good not evil"),
    ("beer_notice", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("cc0_title", "cc0 1 0 universal"),
    ("ccby4_title", "creative commons attribution 4 0 international public license"),
    ("ccbysa4_title", "creative commons attribution sharealike 4 0 international public license"),
    ("ccbync4_title", "creative commons attribution noncommercial 4 0 international public license"),
    ("ccbynd4_title", "creative commons attribution noderivatives 4 0 international public license"),
    ("ccbyncsa4_title", "creative commons attribution noncommercial sharealike 4 0 international public license"),
    ("ccbyncnd4_title", "creative commons attribution noncommercial noderivatives 4 0 international public license"),
    ("proprietary_copying", "unauthorized copying of this file via any medium is strictly prohibited"),
]
#: Parts of words, one of which each of these sentences, or a short note, contains.
ANCHORS = ("licens", "licenc", "granted", "warrant", "redistribut", "copyright", "domain", "reserved", "gpl", "bsd", "apache", "creative commons", "under mit", "under the mit", "under cc", "cc0", "no attribution", "endorse or promote", "advertising materials", "misrepresented", "sell or distribute", "used for good", "whatever you want", "unauthorized copying")
#: Fixed values, in order: licence, family, pattern over the identifiers (each with a space before and behind).
RULES = [
    ("Apache-2.0", "permissive", " apache_header .*apache_obtain | apache_header | apache_licensed | apache_title | apache_named "),
    ("MIT", "permissive", " mit_grant .*as_is | mit_release | mit_licensed | mit_title .*mit_grant | mit_permission .*mit_notice .*as_is | mit_title .*mit_permission | mit_named "),
    ("GPL-3.0", "copyleft", " gpl3_program .*gpl_hope | gpl3_program | gpl3_work | gpl3_title | gpl3_preamble | gpl3_named "),
    ("BSD", "permissive", " bsd_redistribute | bsd_named "),
    ("CC-BY-NC-4.0", "restricted", " ccbync_licensed | ccbync4_title | ccbync4_named "),
    ("CC-BY-SA-4.0", "copyleft", " ccbysa_licensed | ccbysa4_title | ccbysa4_named "),
    ("CC-BY-4.0", "permissive", " ccby_licensed | ccby4_title | ccby4_named "),
    ("CC0-1.0", "permissive", " cc0_waived | public_domain | cc0_title | cc0_named "),
    ("GPL-1.0", "copyleft", " gpl1_title "),
    ("GPL-2.0", "copyleft", " gpl2_program | gpl2_title | gpl2_preamble | gpl2_named "),
    ("GPL", "copyleft", " gpl_named "),
    ("LGPL-2.0", "copyleft", " lgpl2_library | lgpl2_title | lgpl2_named "),
    ("LGPL-2.1", "copyleft", " lgpl21_library | lgpl21_title | lgpl21_preamble | lgpl21_named "),
    ("LGPL-3.0", "copyleft", " lgpl3_library | lgpl3_title | lgpl3_preamble | lgpl3_named "),
    ("AGPL-3.0", "copyleft", " agpl3_program | agpl3_title | agpl3_preamble | agpl3_named "),
    ("GFDL-1.3", "copyleft", " gfdl13_title | gfdl13_document | gfdl13_named "),
    ("MPL-1.1", "copyleft", " mpl11_subject | mpl11_named "),
    ("MPL-2.0", "copyleft", " mpl2_title | mpl2_subject | mpl2_named "),
    ("EPL-1.0", "copyleft", " epl1_title | epl1_named "),
    ("EPL-2.0", "copyleft", " epl2_title | epl2_named "),
    ("EUPL-1.2", "copyleft", " eupl12_title | eupl12_named "),
    ("CDDL-1.0", "copyleft", " cddl1_title | cddl1_named "),
    ("MIT-0", "permissive", " mit0_grant .*as_is | mit0_title .*mit0_grant | mit0_named "),
    ("BSD-2-Clause", "permissive", " bsd_redistribute .*bsd_source .*bsd_binary | bsd2_named "),
    ("BSD-3-Clause", "permissive", " bsd_redistribute .*bsd_endorse | bsd3_named "),
    ("BSD-4-Clause", "permissive", " bsd_redistribute .*bsd_advert .*bsd_endorse | bsd4_named "),
    ("ISC", "permissive", " isc_grant | isc_named "),
    ("0BSD", "permissive", " 0bsd_grant | 0bsd_named "),
    ("Unlicense", "permissive", " unlicense_free | unlicense_anyone | unlicense_named "),
    ("Zlib", "permissive", " zlib_grant | zlib_origin .*zlib_altered | zlib_named "),
    ("BSL-1.0", "permissive", " boost_title .*boost_grant | boost_grant | boost_named "),
    ("PostgreSQL", "permissive", " postgresql_grant | postgresql_named "),
    ("Python-2.0", "permissive", " psf2_title | psf2_named "),
    ("Artistic-2.0", "permissive", " artistic2_title | artistic2_named "),
    ("OFL-1.1", "permissive", " ofl11_title | ofl11_licensed | ofl11_named "),
    ("MS-PL", "permissive", " mspl_title | mspl_named "),
    ("WTFPL", "permissive", " wtfpl_title | wtfpl_copy | wtfpl_named "),
    ("Beerware", "permissive", " beer_notice "),
    ("JSON", "restricted", " json_evil "),
    ("CC-BY-NC-SA-4.0", "restricted", " ccbyncsa4_title | ccbyncsa4_named "),
    ("CC-BY-NC-ND-4.0", "restricted", " ccbyncnd4_title | ccbyncnd4_named "),
    ("CC-BY-ND-4.0", "restricted", " ccbynd4_title | ccbynd4_named "),
    ("CC-BY-NC-3.0", "restricted", " ccbync3_named "),
    ("CC-BY-SA-3.0", "copyleft", " ccbysa3_named "),
    ("CC-BY-3.0", "permissive", " ccby3_named "),
    ("CC-BY-NC-SA-3.0", "restricted", " ccbyncsa3_named "),
    ("CC-BY-NC-ND-3.0", "restricted", " ccbyncnd3_named "),
    ("CC-BY-ND-3.0", "restricted", " ccbynd3_named "),
    ("proprietary", "restricted", " reserved | proprietary_copying "),
]
#: A licence, and those that say more and take its place.
NARROWER = {"BSD": ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"), "BSD-2-Clause": ("BSD-3-Clause", "BSD-4-Clause"), "BSD-3-Clause": ("BSD-4-Clause",), "MIT": ("MIT-0",)}
_LICENSE, _CC = "licen[sc]e", "(?:cc|creative commons)"
_VERSION = lambda v: f"(?: ?v| ?version)? ?{v}"
_GNU = lambda kind, short, v: f"(?:gnu )?(?:{kind} ?general public {_LICENSE}|{short})(?: {short})?{_VERSION(v)}"
_NC, _SA, _ND = " (?:nc|non ?commercial)", " (?:sa|share ?alike)", " (?:nd|no ?deriv(?:ative)?s)"
_CC_KINDS = [("ncsa", "nc sa ", _NC + _SA), ("ncnd", "nc nd ", _NC + _ND), ("nd", "nd ", _ND), ("nc", "nc ", _NC), ("sa", "sa ", _SA), ("", "", "")]
#: Identifier, SPDX name, and name in prose, both over normalised text; they end with a word.
NAMES = [
    ("mit_named", "mit", f"(?:mit|mit x11|expat|mit expat)(?: {_LICENSE}|$)"),
    ("mit0_named", "mit 0", f"(?:mit no attribution|mit 0)(?: {_LICENSE}|$)"),
    ("apache_named", "apache 2 0", f"(?:apache(?: software)? {_LICENSE}{_VERSION('2(?: 0)?')}|apache ?v?2(?: 0)?(?: {_LICENSE}|$))"),
    ("gpl3_named", "gpl 3 0", _GNU("", "gpl", "3(?: 0)?")),
    ("gpl2_named", "gpl 2 0", _GNU("", "gpl", "2(?: 0)?")),
    ("gpl_named", None, f"(?:gnu )?(?:general public {_LICENSE}|gpl)(?: gpl)?"),
    ("lgpl2_named", "lgpl 2 0", _GNU("(?:lesser|library)", "lgpl", "2(?: 0)?(?: [^1]|$)")),
    ("lgpl21_named", "lgpl 2 1", _GNU("lesser", "lgpl", "2 1")),
    ("lgpl3_named", "lgpl 3 0", _GNU("lesser", "lgpl", "3(?: 0)?")),
    ("agpl3_named", "agpl 3 0", _GNU("affero", "agpl", "3(?: 0)?")),
    ("gfdl13_named", "gfdl 1 3", f"(?:gnu )?(?:free documentation {_LICENSE}|gfdl)(?: gfdl)?{_VERSION('1 3')}"),
    ("mpl11_named", "mpl 1 1", f"(?:mozilla public {_LICENSE}|mpl)(?: mpl)?{_VERSION('1 1')}"),
    ("mpl2_named", "mpl 2 0", f"(?:mozilla public {_LICENSE}|mpl)(?: mpl)?{_VERSION('2(?: 0)?')}"),
    ("epl1_named", "epl 1 0", f"(?:eclipse public {_LICENSE}|epl)(?: epl)?{_VERSION('1 0')}"),
    ("epl2_named", "epl 2 0", f"(?:eclipse public {_LICENSE}|epl)(?: epl)?{_VERSION('2(?: 0)?')}"),
    ("eupl12_named", "eupl 1 2", f"(?:european union public {_LICENSE}|eupl)(?: eupl)?{_VERSION('1 2')}"),
    ("cddl1_named", "cddl 1 0", f"(?:common development and distribution {_LICENSE}|cddl)(?: cddl)?{_VERSION('1 0')}"),
    ("bsd2_named", "bsd 2 clause", f"(?:(?:simplified|freebsd) bsd(?: {_LICENSE}|$)|bsd 2 clause|(?:2|two) clause bsd)"),
    ("bsd3_named", "bsd 3 clause", f"(?:(?:new|modified|revised) bsd(?: {_LICENSE}|$)|bsd 3 clause|(?:3|three) clause bsd)"),
    ("bsd4_named", "bsd 4 clause", f"(?:original bsd(?: {_LICENSE}|$)|bsd 4 clause|(?:4|four) clause bsd)"),
    ("bsd_named", None, f"bsd(?: {_LICENSE}|$)"),
    ("0bsd_named", "0bsd", f"(?:0bsd|zero clause bsd)(?: {_LICENSE}|$)"),
    ("isc_named", "isc", f"isc {_LICENSE}"),
    ("unlicense_named", "unlicense", "unlicense"),
    ("zlib_named", "zlib", f"zlib(?: libpng)? {_LICENSE}"),
    ("boost_named", "bsl 1 0", f"boost software {_LICENSE}{_VERSION('1 0')}"),
    ("postgresql_named", "postgresql", f"postgresql {_LICENSE}"),
    ("psf2_named", "(?:python|psf) 2 0", f"(?:psf|python software foundation|python) {_LICENSE}(?:{_VERSION('2(?: 0)?')})?"),
    ("artistic2_named", "artistic 2 0", f"artistic {_LICENSE}{_VERSION('2(?: 0)?')}"),
    ("ofl11_named", "ofl 1 1", f"(?:sil )?(?:open font {_LICENSE}|ofl)(?: ofl)?{_VERSION('1 1')}"),
    ("mspl_named", "ms pl", f"(?:microsoft public {_LICENSE}|ms pl)"),
    ("wtfpl_named", "wtfpl", "wtfpl"),
    ("cc0_named", "cc0 1 0", f"(?:cc0|creative commons zero)(?:{_VERSION('1 0')})?"),
    *[(f"ccby{k}{v[0]}_named", f"cc by {spdx}{v}", f"{_CC} (?:by|attribution){prose} {_VERSION(v).lstrip()}") for v in ("4 0", "3 0") for k, spdx, prose in _CC_KINDS],
]
#: What stands before a name in prose, and what takes the sense from it.
_GIVEN = "(?:licen[sc]ed|dual licen[sc]ed|released|distributed|redistributed|published|available|provided|covered|governed|offered|shared)"
LEAD = f"(?:^| ){_GIVEN} (?:[a-z]+ )?(?:under|by|through|with)(?: either)?(?: the| a| an)?(?: terms)?(?: and conditions)?(?: of)?(?: the| a| an)? (?:[a-z0-9 ]+ (?:or|and)(?: the)? )?"
LEADS, TAG = f"(?:^| ){_GIVEN} ", "(?:^| )spdx license identifier "
DENIED = f"(?:^| )(?:not|never|no longer|cannot be)(?: [a-z]+)?(?: [a-z]+)? {_GIVEN}(?: |$)"
#: A name with "licensed" behind it, and what takes the sense from that.
BEHIND = lambda spdx: f"(?:(?:^| )(?:is|are|was|were|stays|remains)(?: [a-z]+)? {spdx}(?: {_LICENSE})? licen[sc]ed(?: |$)|^{spdx} licen[sc]ed$)"
BEHIND_DENIED = "(?:^| )(?:not|never|no longer|non)(?: [a-z0-9]+){1,5} licen[sc]ed(?: |$)"
#: A reservation of rights says something only where no licence is found beside it; a ban on copying always does.
_RESERVED, _BAN = "proprietary", " proprietary_copying "
#: Fixed value: a GPL with its version, which isn't one of no version.
VERSIONED = f"(?:general public {_LICENSE}|gpl)(?: gpl)? ?(?:gpl )?(?:v|version)? ?[0-9]"
_LAST_WINS = ("restricted", "copyleft", "permissive")
#: What is replaced, in this order, by the four readings, of which the last takes marks at the beginning of a line for bullets, not comments; a byte 1 ends a sentence, as a line break does in the first.
_END, _BLANK, _MARK = "([.!?])[ \\t\\r\\n]+", "\\r?\\n\\r?\\n", "[ \\t]*(?://+|/?[*]+/?|#+|;+|--+|%+|>+|<!--|\"\"\")[ \\t]*"
_LIST = "[ \\t]*(?:[(]?[0-9]{1,2}[.)]|[(]?[a-z][)]|[*+o\u2022\u00b7-])[ \\t]+"
READINGS = {
    "a": [("([.!?])[ \\t\\r]+", 1), ("\n", 0)],
    "b": [(_BLANK, 0), (_END, 1)],
    "c": [(f"(?m)^{_MARK}", None), ("(?m)[ \\t\\r]+$", None), ("\n\n+", 0), (f"(?m)^{_LIST}", 0), (_END, 1)],
    "d": [("(?m)[ \\t\\r]+$", None), ("\n\n+", 0), (f"(?m)^{_LIST}", 0), (_END, 1)],
}


def _hit(name: str) -> tuple[str, str | None]:
    """Pattern of a licence over the identifiers, and that of those which take its place."""
    patterns = {n: p for n, _, p in RULES}
    return patterns[name], "|".join(patterns[n] for n in NARROWER[name]) if name in NARROWER else None


def _prose(identifier: str, name: str) -> str:
    """Pattern of a name behind its lead; that of one licence says itself what may follow."""
    return f"{LEAD}{name}" if identifier == "lgpl2_named" else f"{LEAD}{name}(?: |$)"


def _reading(text: Column, steps: list[tuple[str, int | None]]) -> Column:
    """Normalised sentences with an anchor, in order. Only a line feed ends a line."""
    for pattern, kind in steps:
        text = F.regexp_replace(text, pattern.replace("(?m)", "(?md)"), {None: "", 0: "\u0001", 1: "$1\u0001"}[kind])
    telling = F.filter(F.split(text, "\u0001"), lambda s: _anchored(s))
    return F.transform(telling, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))


def _identifiers(sentences: Column) -> Column:
    """Identifiers of the known sentences and of names in the others, in order."""
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES for x in (s, i)])
    return F.flatten(F.transform(sentences, lambda s: F.when(F.element_at(known, s).isNotNull(), F.array(F.element_at(known, s))).otherwise(_names(s))))


def _names(sentence: Column) -> Column:
    """Identifiers of the licences that a normalised sentence names."""
    plain = F.regexp_replace(sentence, VERSIONED, "versioned")
    tagged = F.array_compact(F.array(*[F.when(sentence.rlike(f" identifier (?:.* )?{n}(?: |$)"), F.lit(i)) for i, n, _ in NAMES if n]))
    prose = F.array_compact(F.array(*[F.when((plain if i == "gpl_named" else sentence).rlike(_prose(i, p)), F.lit(i)) for i, _, p in NAMES]))
    leads = sentence.rlike(LEADS) & ~sentence.rlike(DENIED)
    behind = F.array_compact(F.array(*[F.when(sentence.rlike(BEHIND(n)), F.lit(i)) for i, n, _ in NAMES if n]))
    none = F.array().cast("array<string>")
    prose = F.array_union(F.when(leads, prose).otherwise(none), F.when(sentence.rlike(" licen[sc]ed(?: |$)") & ~sentence.rlike(BEHIND_DENIED), behind).otherwise(none))
    return F.when(sentence.rlike(TAG), tagged).otherwise(prose)


def _anchored(text: Column) -> Column:
    low = F.translate(text, UPPER, LOWER)
    out = F.lit(False)
    for a in ANCHORS:
        out = out | low.contains(a)
    return out


def scan(df: DataFrame, text_col: str = "text", into: str = "licence") -> DataFrame:
    """All columns and the struct ``into``: sentences (identifiers in order), licences (by rule), verdict and the count."""
    text, none = F.coalesce(F.col(text_col), F.lit("")), F.array().cast("array<string>")
    telling = _anchored(text)
    readings = F.struct(*[F.when(telling, _identifiers(_reading(text, steps))).otherwise(none).alias(k) for k, steps in READINGS.items()])
    rows = df.withColumn("_readings", readings)
    all3 = F.col("_readings")
    most = F.greatest(*[F.size(all3[x]) for x in READINGS])
    ids = all3["d"]
    for k in ("c", "b", "a"):
        ids = F.when(F.size(all3[k]) == most, all3[k]).otherwise(ids)
    rows = rows.withColumn("_ids", ids).withColumn("_line", F.concat(F.lit(" "), F.array_join("_ids", "  "), F.lit(" ")))
    line, found = F.col("_line"), []
    for name, family, _ in RULES:
        own, wider = _hit(name)
        hit = line.rlike(own) if wider is None else line.rlike(own) & ~line.rlike(wider)
        found.append(F.when(hit, F.struct(F.lit(name).alias("name"), F.lit(family).alias("family"))))
    rows = rows.withColumn("_rules", F.when(F.size("_ids") > 0, F.array_compact(F.array(*found))).otherwise(F.array().cast("array<struct<name:string,family:string>>")))
    alone = (F.size("_rules") < 2) | F.contains("_line", F.lit(_BAN))
    rows = rows.withColumn("_rules", F.when(alone, F.col("_rules")).otherwise(F.filter("_rules", lambda r: r["name"] != _RESERVED)))
    families = F.col("_rules")["family"]
    verdict = F.lit("none")
    for f in reversed(_LAST_WINS):
        verdict = F.when(F.array_contains(families, f), f).otherwise(verdict)
    out = F.struct(F.array_join("_ids", " ").alias("sentences"), F.array_join(F.col("_rules")["name"], ",").alias("licences"), verdict.alias("verdict"), F.size("_ids").cast("long").alias("n_sentences"))
    return rows.withColumn(into, out).drop("_readings", "_ids", "_line", "_rules")


#: What a step of a reading puts in place of its match.
_BY = {None: "''", 0: "chr(1)", 1: "'\\1' || chr(1)"}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def scan_sql(table: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> str:
    """The scan as DuckDB SQL."""
    low = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    matches = lambda x, p: f"regexp_matches({x}, {_quoted(p)})"
    anchored = lambda x: "(" + " OR ".join(f"contains({low(x)}, '{a}')" for a in ANCHORS) + ")"
    listed = lambda found: f"[i FOR i IN [{', '.join(found)}] IF i IS NOT NULL]"
    known = "MAP {" + ", ".join(f"{_quoted(s)}: {_quoted(i)}" for i, s in SENTENCES) + "}"

    def reading(steps: list[tuple[str, int | None]]) -> str:
        x = "x"
        for pattern, kind in steps:
            x = f"regexp_replace({x}, {_quoted(pattern)}, {_BY[kind]}, 'g')"
        return f"CASE WHEN {anchored('x')} THEN [trim(regexp_replace({low('s')}, '[^a-z0-9]+', ' ', 'g')) FOR s IN string_split({x}, chr(1)) IF {anchored('s')}] ELSE [] END"

    tagged = listed([f"CASE WHEN {matches('s', f' identifier (?:.* )?{n}(?: |$)')} THEN '{i}' END" for i, n, _ in NAMES if n])
    plain = f"regexp_replace(s, {_quoted(VERSIONED)}, 'versioned', 'g')"
    prose = listed([f"CASE WHEN {matches(plain if i == 'gpl_named' else 's', _prose(i, p))} THEN '{i}' END" for i, _, p in NAMES])
    behind = listed([f"CASE WHEN {matches('s', BEHIND(n))} THEN '{i}' END" for i, n, _ in NAMES if n])
    led = f"CASE WHEN {matches('s', LEADS)} AND NOT {matches('s', DENIED)} THEN {prose} ELSE [] END"
    after = f"CASE WHEN {matches('s', ' licen[sc]ed(?: |$)')} AND NOT {matches('s', BEHIND_DENIED)} THEN {behind} ELSE [] END"
    names = f"CASE WHEN {matches('s', TAG)} THEN {tagged} ELSE {led} || [i FOR i IN {after} IF NOT list_contains({led}, i)] END"
    identifiers = lambda k: f"flatten([CASE WHEN known[s] IS NOT NULL THEN [known[s]] ELSE {names} END FOR s IN {k}])"
    hits = [(n, f, *_hit(n)) for n, f, _ in RULES]
    rules = listed([f"CASE WHEN {matches('line', own)}{'' if wider is None else ' AND NOT ' + matches('line', wider)} THEN {{'name': '{n}', 'family': '{f}'}} END" for n, f, own, wider in hits])
    verdict = "CASE " + " ".join(f"WHEN len([r FOR r IN rules IF r.family = '{f}']) > 0 THEN '{f}'" for f in _LAST_WINS) + " ELSE 'none' END"
    return f"""
WITH t AS (SELECT {id_col}, coalesce({text_col}, '') AS x, {known} AS known FROM {table}),
r AS (SELECT {id_col}, known, {', '.join(f'{reading(steps)} AS s{k}' for k, steps in READINGS.items())} FROM t),
n AS (SELECT {id_col}, {', '.join(f"{identifiers(f's{k}')} AS {k}" for k in READINGS)} FROM r),
i AS (SELECT {id_col}, CASE greatest(len(a), len(b), len(c), len(d)) WHEN len(a) THEN a WHEN len(b) THEN b WHEN len(c) THEN c ELSE d END AS ids FROM n),
m AS (SELECT {id_col}, ids, ' ' || array_to_string(ids, '  ') || ' ' AS line FROM i),
g AS (SELECT {id_col}, ids, line, CASE WHEN len(ids) > 0 THEN {rules} ELSE [] END AS rules FROM m),
h AS (SELECT {id_col}, ids, CASE WHEN len(rules) < 2 OR contains(line, '{_BAN}') THEN rules ELSE [r FOR r IN rules IF r.name <> '{_RESERVED}'] END AS rules FROM g)
SELECT {id_col}, array_to_string(ids, ' ') AS sentences, array_to_string([r.name FOR r IN rules], ',') AS licences, {verdict} AS verdict, CAST(len(ids) AS BIGINT) AS n_sentences FROM h
"""
