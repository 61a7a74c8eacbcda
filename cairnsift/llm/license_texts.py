"""Wording of public licences and their notices, as templates for ``license_scan``."""

# Phrases that name a licence, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licence wording. Punctuation and case do not count.
MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
shall be included in all copies or substantial portions of the Software.
<<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name=holder;words=1-16>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.<<endOptional>>
"""
ISC = """
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
BSD_2 = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=holder;words=1-16>> may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<var;name=what;words=1-3>> except in
compliance with the License. You may obtain a copy of the License at
<<beginOptional>><<var;name=scheme;words=1>>://www.apache.org/licenses/LICENSE-2.0<<endOptional>>
"""
GNU_NOTICE = """
is free software; you <<var;name=modal;words=1>> redistribute it and/or modify it under the terms of the
GNU {kind} General Public License as published by the Free Software Foundation;
<<beginOptional>>either<<endOptional>> version {version} <<beginOptional>>of the License<<endOptional>>
<<beginOptional>>or (at your option) any later version<<endOptional>>
"""
GNU_LINE = """
licensed under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> <<beginOptional>>GNU<<endOptional>> {kind}
General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, <<beginOptional>>either<<endOptional>> version {version}
"""
UNLICENSE = """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.
"""
ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions
"""
BOOST = """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software
"""
MPL = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at <<beginOptional>><<var;name=scheme;words=1>>://mozilla.org/MPL/2.0/<<endOptional>>
"""
APACHE_LINE = """
licensed under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> Apache License,
<<beginOptional>>Version<<endOptional>> 2.0
"""
MIT_LINE = "{how} under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> MIT license"
CC_LINE = """
licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> {name} <<var;name=version;words=2;match=digits>>
<<beginOptional>>International<<endOptional>> <<beginOptional>>License<<endOptional>>
"""
GNU_KINDS = {"gpl": "", "lgpl": "Lesser", "agpl": "Affero"}
CC_WORDS = {"by": "Attribution", "sa": "ShareAlike", "nc": "NonCommercial", "nd": "NoDerivatives"}
CC_GRANTS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")

TEMPLATES: list[tuple[str, str]] = [
    ("mit", MIT), ("isc", ISC), ("bsd-2-clause", BSD_2), ("bsd-3-clause", BSD_3), ("apache-2.0", APACHE_NOTICE),
    ("unlicense", UNLICENSE), ("zlib", ZLIB), ("bsl-1.0", BOOST), ("mpl-2.0", MPL), ("apache-2.0", APACHE_LINE),
    *(("mit", MIT_LINE.format(how=how)) for how in ("licensed", "released", "available", "distributed")),
    *((f"{label}-{version}.0", text.format(kind=kind, version=version))
      for text in (GNU_NOTICE, GNU_LINE) for label, kind in GNU_KINDS.items() for version in (2, 3)),
    *((f"cc-{grant}", CC_LINE.format(name=name)) for grant in CC_GRANTS
      for name in (f"CC {grant}", "Creative Commons " + "-".join(CC_WORDS[g] for g in grant.split("-")))),
]
