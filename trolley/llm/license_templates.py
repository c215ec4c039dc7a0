"""Wording of licence notices and of short licences, by SPDX identifier."""

# Public licence texts, with blanks for years and names left out.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""

BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", APACHE_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", MIT),
    ("BSD-2-Clause", BSD_TWO + " " + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_TWO + " " + BSD_THIRD + " " + BSD_DISCLAIMER),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", ISC),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", GPL_NOTICE.format(name="General Public License", version="2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", GPL_NOTICE.format(name="General Public License", version="3")),
    ("LGPL-3.0", GPL_NOTICE.format(name="Lesser General Public License", version="3")),
    ("AGPL-3.0", GPL_NOTICE.format(name="Affero General Public License", version="3")),
    ("MPL-2.0", MPL_NOTICE),
    ("Unlicense", UNLICENSE),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

# The other members of the families, and one-line forms of all.
TEMPLATES += [
    ("LGPL-2.1", GPL_NOTICE.format(name="Lesser General Public License", version="2.1")),
    ("LGPL-2.0", GPL_NOTICE.format(name="Library General Public License", version="2")),
    ("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-1.0", "This work is licensed under the GNU General Public License, version 1."),
    ("Apache-1.0", "Licensed under the Apache License, Version 1.0."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-1.0", "Licensed under the Mozilla Public License, Version 1.0."),
    ("MPL-1.1", "Licensed under the Mozilla Public License, Version 1.1."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("Unlicense", "Released under the Unlicense."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
CC_NAMES = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
for variant, name in CC_NAMES.items():
    for version, kind in CC_VERSIONS.items():
        if version < "4":
            name = name.replace("NoDerivatives", "NoDerivs")
        else:
            name = CC_NAMES[variant]
        for text in (
            f"Licensed under CC {variant} {version}.",
            f"This work is licensed under a Creative Commons {name} {version} {kind} License.",
        ):
            if (f"CC-{variant}-{version}", text) not in TEMPLATES:
                TEMPLATES.append((f"CC-{variant}-{version}", text))
for identifier in sorted({name for name, _ in TEMPLATES}):
    TEMPLATES.append((identifier, f"SPDX-License-Identifier: {identifier}"))
    if "GPL-" in identifier:
        TEMPLATES += [(identifier, f"SPDX-License-Identifier: {identifier}-{which}") for which in ("only", "or-later")]

# Words of templates that tell one licence from another, besides versions and SPDX tags.
NAMING = {"apache", "mit", "bsd", "isc", "gnu", "general", "lesser", "library", "affero", "mozilla", "unlicense", "cc0"}
NAMING |= {"cc", "creative", "commons", "public", "domain"} | {n.lower() for pair in CC_NAMES.items() for n in pair}
NAMING |= {n.lower().replace("noderivatives", "noderivs") for n in CC_NAMES.values()}
# Words that make another licence of a notice to which they are added.
QUALIFYING = {"lesser", "affero", "documentation", "sa", "nc", "nd", "noncommercial", "non-commercial"}
QUALIFYING |= {"sharealike", "share-alike", "noderivs", "noderivatives", "no-derivatives", "clear", "x11"}

# Each template has one of these, whatever the case; text without any cannot hold a template.
CUES = ("licen", "permission", "redistribut", "public domain", "warrant", "copyright")
