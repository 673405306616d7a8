"""Words of public licences: whole texts of short ones, notices of long ones, names and tags.

Labels are the identifiers of the licences in lower case. Texts are matched in words
of letters and digits, so their punctuation and case do not count.
"""

from __future__ import annotations

# Names by which texts refer to a licence.
NAMES = {
    "0bsd": ("zero clause bsd license", "bsd zero clause license", "0bsd license"),
    "afl-3.0": ("academic free license version 3.0", "academic free license 3.0"),
    "agpl-3.0": (
        "gnu affero general public license version 3",
        "gnu affero general public license v3",
        "gnu agpl v3",
    ),
    "apache-1.1": ("apache software license version 1.1", "apache license 1.1"),
    "apache-2.0": (
        "apache license version 2.0",
        "apache license 2.0",
        "apache software license 2.0",
        "apache 2.0 license",
    ),
    "artistic-2.0": ("artistic license 2.0", "artistic license version 2.0"),
    "bsd-2-clause": ("bsd 2-clause license", "2-clause bsd license", "simplified bsd license", "freebsd license"),
    "bsd-3-clause": (
        "bsd 3-clause license",
        "3-clause bsd license",
        "new bsd license",
        "modified bsd license",
        "revised bsd license",
    ),
    "bsl-1.0": ("boost software license version 1.0", "boost software license 1.0"),
    "cc0-1.0": (
        "cc0 1.0 universal",
        "creative commons zero v1.0 universal",
        "creative commons cc0 1.0 universal",
        "cc0 public domain dedication",
    ),
    "cddl-1.0": (
        "common development and distribution license version 1.0",
        "common development and distribution license 1.0",
    ),
    "ecl-2.0": ("educational community license version 2.0",),
    "epl-1.0": ("eclipse public license version 1.0", "eclipse public license 1.0", "eclipse public license v1.0"),
    "epl-2.0": ("eclipse public license version 2.0", "eclipse public license 2.0", "eclipse public license v2.0"),
    "eupl-1.2": ("european union public licence version 1.2", "european union public licence v. 1.2", "eupl v1.2"),
    "gfdl-1.3": ("gnu free documentation license version 1.3",),
    "gpl-2.0": (
        "gnu general public license version 2",
        "gnu general public license v2",
        "gnu gpl version 2",
        "gnu gpl v2",
    ),
    "gpl-3.0": (
        "gnu general public license version 3",
        "gnu general public license v3",
        "gnu gpl version 3",
        "gnu gpl v3",
    ),
    "isc": ("isc license",),
    "lgpl-2.1": ("gnu lesser general public license version 2.1", "gnu lesser general public license v2.1"),
    "lgpl-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3"),
    "mit": ("mit license", "the expat license"),
    "mit-0": ("mit no attribution license", "mit no attribution"),
    "mpl-1.1": ("mozilla public license version 1.1", "mozilla public license 1.1"),
    "mpl-2.0": ("mozilla public license version 2.0", "mozilla public license 2.0", "mozilla public license v. 2.0"),
    "ms-pl": ("microsoft public license",),
    "ncsa": ("university of illinois ncsa open source license",),
    "odbl-1.0": ("open database license 1.0", "open database license odbl v1.0"),
    "ofl-1.1": ("sil open font license version 1.1", "sil open font license 1.1"),
    "osl-3.0": ("open software license version 3.0", "open software license 3.0"),
    "postgresql": ("the postgresql license",),
    "python-2.0": ("python software foundation license version 2", "psf license agreement"),
    "unlicense": ("the unlicense",),
    "wtfpl": ("do what the fuck you want to public license",),
    "zlib": ("zlib license",),
}
# Words that lead to a name.
LEADS = ("licensed under", "released under", "distributed under", "available under")
ARTICLES = ("the ", "a ", "")
# Versions of the licences below, with the words that follow them, and their terms.
COMMONS_VERSIONS = {"3.0": "unported", "4.0": "international"}
COMMONS_TERMS = {
    "by": "attribution",
    "by-sa": "attribution sharealike",
    "by-nc": "attribution noncommercial",
    "by-nd": "attribution noderivatives",
    "by-nc-sa": "attribution noncommercial sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
}

_AS_IS = """
the software is provided "as is", without warranty of any kind, express or implied, including but
not limited to the warranties of merchantability, fitness for a particular purpose and
noninfringement. in no event shall the authors or copyright holders be liable for any claim, damages
or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in
connection with the software or the use or other dealings in the software.
"""
_MIT_GRANT = """
permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "software"), to deal in the software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the software, and to permit persons to whom the software is
furnished to do so
"""
_BSD_GRANT = """
redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. redistributions of source code must retain the
above copyright notice, this list of conditions and the following disclaimer. 2. redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_DISCLAIMER = """
this software is provided by the copyright holders and contributors "as is" and any express or
implied warranties, including, but not limited to, the implied warranties of merchantability and
fitness for a particular purpose are disclaimed. in no event shall the copyright holder or
contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential
damages (including, but not limited to, procurement of substitute goods or services; loss of use,
data, or profits; or business interruption) however caused and on any theory of liability, whether
in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of
the use of this software, even if advised of the possibility of such damage.
"""
_ISC_GRANT = "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_DISCLAIMER = """
the software is provided "as is" and the author disclaims all warranties with regard to this
software including all implied warranties of merchantability and fitness. in no event shall the
author be liable for any special, direct, indirect, or consequential damages or any damages
whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence
or other tortious action, arising out of or in connection with the use or performance of this software.
"""
_GNU_NOTICE = """
this program is free software: you can redistribute it and/or modify it under the terms of the {name}
as published by the free software foundation, either version {version} of the license, or (at your
option) any later version. this program is distributed in the hope that it will be useful, but without
any warranty; without even the implied warranty of merchantability or fitness for a particular
purpose. see the {name} for more details.
"""
_EVERYONE_COPIES = "everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
# Whole texts of short licences, notices and opening words of long ones.
TEXTS = {
    "0bsd": (f"{_ISC_GRANT}. {_ISC_DISCLAIMER}",),
    "agpl-3.0": (
        _GNU_NOTICE.format(name="gnu affero general public license", version="3"),
        f"gnu affero general public license version 3, 19 november 2007 copyright (c) 2007 free software foundation, inc. {_EVERYONE_COPIES}",
    ),
    "apache-2.0": (
        """
        licensed under the apache license, version 2.0 (the "license"); you may not use this file except
        in compliance with the license. you may obtain a copy of the license at
        http://www.apache.org/licenses/license-2.0 unless required by applicable law or agreed to in
        writing, software distributed under the license is distributed on an "as is" basis, without
        warranties or conditions of any kind, either express or implied. see the license for the specific
        language governing permissions and limitations under the license.
        """,
        """
        grant of copyright license. subject to the terms and conditions of this license, each contributor
        hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable
        copyright license to reproduce, prepare derivative works of, publicly display, publicly perform,
        sublicense, and distribute the work and such derivative works in source or object form.
        """,
    ),
    "bsd-2-clause": (f"{_BSD_GRANT} {_BSD_DISCLAIMER}",),
    "bsd-3-clause": (
        f"""
        {_BSD_GRANT} 3. neither the name of the copyright holder nor the names of its contributors may be
        used to endorse or promote products derived from this software without specific prior written
        permission. {_BSD_DISCLAIMER}
        """,
    ),
    "bsl-1.0": (
        """
        permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "software") to use, reproduce,
        display, distribute, execute, and transmit the software, and to prepare derivative works of the
        software, and to permit third-parties to whom the software is furnished to do so, all subject to the
        following:
        """,
    ),
    "cc0-1.0": (
        "to the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "cddl-1.0": (
        """
        the contents of this file are subject to the terms of the common development and distribution license
        (the "license"). you may not use this file except in compliance with the license.
        """,
    ),
    "epl-2.0": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0",
    ),
    "gfdl-1.3": (
        """
        permission is granted to copy, distribute and/or modify this document under the terms of the gnu free
        documentation license, version 1.3 or any later version published by the free software foundation
        """,
    ),
    "gpl-2.0": (
        _GNU_NOTICE.format(name="gnu general public license", version="2"),
        f"gnu general public license version 2, june 1991 copyright (c) 1989, 1991 free software foundation, inc. {_EVERYONE_COPIES}",
    ),
    "gpl-3.0": (
        _GNU_NOTICE.format(name="gnu general public license", version="3"),
        f"gnu general public license version 3, 29 june 2007 copyright (c) 2007 free software foundation, inc. {_EVERYONE_COPIES}",
    ),
    "isc": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_DISCLAIMER}",
    ),
    "lgpl-2.1": (
        _GNU_NOTICE.format(name="gnu lesser general public license", version="2.1"),
        f"gnu lesser general public license version 2.1, february 1999 copyright (c) 1991, 1999 free software foundation, inc. {_EVERYONE_COPIES}",
    ),
    "lgpl-3.0": (
        _GNU_NOTICE.format(name="gnu lesser general public license", version="3"),
        f"gnu lesser general public license version 3, 29 june 2007 copyright (c) 2007 free software foundation, inc. {_EVERYONE_COPIES}",
    ),
    "mit": (
        f"""
        {_MIT_GRANT}, subject to the following conditions: the above copyright notice and this permission
        notice shall be included in all copies or substantial portions of the software. {_AS_IS}
        """,
        # The grant and the disclaimer also stand alone.
        f"{_MIT_GRANT}, subject to the following conditions:",
        _MIT_GRANT.split(", to deal")[0] + ", to deal in the software without restriction",
        _AS_IS,
    ),
    "mit-0": (f"{_MIT_GRANT}. {_AS_IS}",),
    "mpl-1.1": (
        """
        the contents of this file are subject to the mozilla public license version 1.1 (the "license"); you
        may not use this file except in compliance with the license. you may obtain a copy of the license at
        http://www.mozilla.org/mpl/
        """,
    ),
    "mpl-2.0": (
        """
        this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the
        mpl was not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0/.
        """,
    ),
    "ofl-1.1": (
        """
        permission is hereby granted, free of charge, to any person obtaining a copy of the font software, to
        use, study, copy, merge, embed, modify, redistribute, and sell modified and unmodified copies of the
        font software, subject to the following conditions:
        """,
        "this font software is licensed under the sil open font license, version 1.1.",
    ),
    "postgresql": (
        """
        permission to use, copy, modify, and distribute this software and its documentation for any purpose,
        without fee, and without a written agreement is hereby granted, provided that the above copyright
        notice and this paragraph and the following two paragraphs appear in all copies.
        """,
    ),
    "unlicense": (
        f"""
        this is free and unencumbered software released into the public domain. anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means. in jurisdictions that recognize
        copyright laws, the author or authors of this software dedicate any and all copyright interest in the
        software to the public domain. we make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors. we intend this dedication to be an overt act of relinquishment in
        perpetuity of all present and future rights to this software under copyright law. {_AS_IS}
        """,
        "this is free and unencumbered software released into the public domain",
    ),
    "wtfpl": (
        f"""
        do what the fuck you want to public license version 2, december 2004 {_EVERYONE_COPIES} do what the fuck
        you want to public license terms and conditions for copying, distribution and modification 0. you just do
        what the fuck you want to.
        """,
    ),
    "zlib": (
        """
        this software is provided 'as-is', without any express or implied warranty. in no event will the authors
        be held liable for any damages arising from the use of this software. permission is granted to anyone to
        use this software for any purpose, including commercial applications, and to alter it and redistribute it
        freely, subject to the following restrictions: 1. the origin of this software must not be misrepresented;
        you must not claim that you wrote the original software. if you use this software in a product, an
        acknowledgment in the product documentation would be appreciated but is not required. 2. altered source
        versions must be plainly marked as such, and must not be misrepresented as being the original software.
        3. this notice may not be removed or altered from any source distribution.
        """,
    ),
}


def commons_names() -> dict[str, tuple[str, ...]]:
    """Names of the licences that are built from terms and versions."""
    return {
        f"cc-{short}-{version}": (
            f"creative commons {terms} {version} {suffix} license",
            f"creative commons {terms} {version} license",
            f"cc {short} {version}",
        )
        for short, terms in COMMONS_TERMS.items()
        for version, suffix in COMMONS_VERSIONS.items()
    }


def tags(labels: list[str]) -> dict[str, tuple[str, ...]]:
    """The lines by which source files name a licence."""
    return {label: (f"spdx license identifier {label}",) for label in labels}


def led(names: tuple[str, ...]) -> tuple[str, ...]:
    """The names, and the names behind the words that lead to them."""
    return (*names, *(f"{lead} {article}{name}" for name in names for lead in LEADS for article in ARTICLES))


def catalogue() -> dict[str, tuple[str, ...]]:
    """All texts, names and tags by label."""
    named = NAMES | commons_names()
    labels = sorted({*named, *TEXTS})
    tagged = tags(labels)
    return {label: (*TEXTS.get(label, ()), *led(named.get(label, ())), *tagged[label]) for label in labels}
