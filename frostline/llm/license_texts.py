"""Public license texts and notices that documents are scanned for.

Whole texts lie in ``licenses``, one file each; what follows the terms there (how to apply them) is not looked for.
Short notices come in the usual wordings. What they have in common is enough, so that words before or after do not matter.
"""

import re
from pathlib import Path

# Notices and texts as their publishers word them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "BSD-3-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used
        to endorse or promote products derived from this software without specific prior written permission.""",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT notice": "Released under the MIT License.",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "MPL-2.0 header": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
}

_BSD = """
    Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
    of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution."""
TEMPLATES |= {
    "BSD-2-Clause": _BSD,
    "BSD disclaimer": """
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
        USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC disclaimer": """
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "EPL-2.0 notice": """
        This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0
        which is available at""",
    "EPL-1.0 notice": """
        This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0
        which accompanies this distribution""",
}

#: The names by which short notices call a license.
_NAMES = {
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GNU GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GNU GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
}
_VERBS = ("licensed under the", "released under the", "distributed under the", "available under the", "provided under the", "the terms of the")
_SPDX = (
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0", "CC0-1.0",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)
_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


_known = {tuple(re.findall("[a-z0-9]+", _text.lower())) for _text in TEMPLATES.values()}


def _add(name: str, text: str) -> None:
    """Add a wording that is not there yet in the same words."""
    words = tuple(re.findall("[a-z0-9]+", text.lower()))
    if words not in _known:
        _known.add(words)
        TEMPLATES[name] = text


for _license, _calls in _NAMES.items():
    for _call in _calls:
        for _verb in _VERBS:
            _add(f"{_license} notice: {_verb} {_call}", f"{_verb} {_call}")
for _part, _long in _COMMONS.items():
    for _version in ("3.0", "4.0"):
        _add(f"CC-{_part}-{_version} notice: long", f"Creative Commons {_long} {_version}")
        for _verb in ("licensed under", "released under", "available under"):
            _add(f"CC-{_part}-{_version} notice: {_verb}", f"{_verb} CC {_part} {_version}")
_add("CC0-1.0 notice: long", "CC0 1.0 Universal Public Domain Dedication")
for _verb in ("licensed under", "released under", "available under"):
    _add(f"CC0-1.0 notice: {_verb}", f"{_verb} CC0 1.0")
for _license in _SPDX:
    _add(f"{_license} SPDX", f"SPDX-License-Identifier: {_license}")
for _file in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
    TEMPLATES[f"{_file.stem} text"] = _file.read_text(encoding="utf-8").split("END OF TERMS AND CONDITIONS")[0]
