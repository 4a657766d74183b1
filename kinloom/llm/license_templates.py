"""Notices and texts of common licenses, the templates of the license scan.

Short notices are made by rule from names. Longer ones are fixed values: the wording is that
of the public license texts.
"""

from __future__ import annotations

#: Names under which a license is referred to, by SPDX identifier.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License",),
    "MIT-0": ("MIT No Attribution License",),
    "0BSD": ("Zero-Clause BSD License", "0BSD License"),
    "BSD": ("BSD License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "BSD-4-Clause": ("BSD 4-Clause License",),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "Apache-1.1": ("Apache Software License, Version 1.1",),
    "GPL-1.0": ("GNU General Public License, version 1", "GPL version 1"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2 License", "GPL version 2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3 License", "GPL version 3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL version 2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL version 3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL version 3"),
    "GFDL-1.3": ("GNU Free Documentation License, Version 1.3",),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"),
    "EPL-1.0": ("Eclipse Public License v1.0", "Eclipse Public License 1.0"),
    "EPL-2.0": ("Eclipse Public License v2.0", "Eclipse Public License 2.0"),
    "EUPL-1.1": ("European Union Public Licence, Version 1.1", "EUPL, Version 1.1"),
    "EUPL-1.2": ("European Union Public Licence, Version 1.2", "EUPL, Version 1.2"),
    "CDDL-1.0": ("Common Development and Distribution License, Version 1.0", "Common Development and Distribution License 1.0"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "OFL-1.1": ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
    "PSF-2.0": ("Python Software Foundation License Version 2",),
    "PostgreSQL": ("PostgreSQL License",),
    "NCSA": ("University of Illinois/NCSA Open Source License",),
    "MS-PL": ("Microsoft Public License",),
    "WTFPL": ("Do What The Fuck You Want To Public License",),
    "Unlicense": ("Unlicense",),
    "ODbL-1.0": ("Open Database License v1.0", "Open Database License 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal License"),
    "CC-BY-3.0": ("CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
#: How a name is brought in.
FRAMES = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is licensed under the terms of the {}.", "Distributed under the {}.", "Distributed under the terms of the {}.", "Available under the {}.", "Subject to the terms of the {}.")
#: Without an article, as the names of the Creative Commons are.
BARE = ("Licensed under {}.", "Released under {}.", "This work is licensed under a {}.")
SPDX = "SPDX-License-Identifier: {}"

#: Paragraphs of the license texts.
_WARRANTY_BSD = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_MIT_LIABLE = "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_GNU = "This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{mark2} either version {version} of the License, or (at your option) any later version."
_GNU_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."

TEXTS: dict[str, tuple[str, ...]] = {
    "MIT": (
        f"{_MIT_GRANT}, subject to the following conditions:",
        _MIT_NOTICE,
        _MIT_WARRANTY,
        f"{_MIT_WARRANTY} {_MIT_LIABLE}",
        f"{_MIT_GRANT}, subject to the following conditions: {_MIT_NOTICE} {_MIT_WARRANTY} {_MIT_LIABLE}",
    ),
    "MIT-0": (f"{_MIT_GRANT}. {_MIT_WARRANTY} {_MIT_LIABLE}",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (_GNU.format(thing="program", kind="", mark=":", mark2=",", version="3"),),
    "GPL-2.0": (_GNU.format(thing="program", kind="", mark=";", mark2=";", version="2"),),
    "LGPL-2.1": (_GNU.format(thing="library", kind="Lesser ", mark=";", mark2=";", version="2.1"),),
    "LGPL-3.0": (_GNU.format(thing="program", kind="Lesser ", mark=":", mark2=",", version="3"),),
    "AGPL-3.0": (_GNU.format(thing="program", kind="Affero ", mark=":", mark2=",", version="3"), _GNU_WARRANTY.format(kind="Affero ")),
    "GPL": (_GNU_WARRANTY.format(kind=""),),
    "LGPL": (_GNU_WARRANTY.format(kind="Lesser "),),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",),
    "BSD": (_BSD_HEAD, _BSD_SOURCE, _BSD_BINARY, _WARRANTY_BSD),
    "BSD-2-Clause": (f"{_BSD_HEAD} {_BSD_SOURCE} {_BSD_BINARY} {_WARRANTY_BSD}",),
    "BSD-3-Clause": (_BSD_NAMES, f"{_BSD_HEAD} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES} {_WARRANTY_BSD}"),
    "ISC": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.",
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}",
    ),
    "0BSD": (f"{_ISC_GRANT}. {_ISC_WARRANTY}",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "EPL-1.0": ("All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",),
    "EUPL-1.2": ("Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence.",),
    "CDDL-1.0": ("The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License.",),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ at: http://scripts.sil.org/OFL",),
    "PostgreSQL": ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",),
    "NCSA": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "GFDL-1.3": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.",),
    "WTFPL": ("This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Proprietary": ("All rights reserved. No part of this work may be reproduced without permission.", "This software is the confidential and proprietary information of the copyright holder. Unauthorized copying of this file, via any medium, is strictly prohibited."),
}


def templates() -> dict[str, tuple[str, ...]]:
    """Texts and notices by license; the notices are every name in every frame."""
    out: dict[str, list[str]] = {k: list(v) for k, v in TEXTS.items()}
    for spdx, names in NAMES.items():
        own = out.setdefault(spdx, [])
        frames = BARE if spdx.startswith("CC") else FRAMES
        own += [f.format(n) for n in names for f in frames]
        if spdx != "BSD":
            own.append(SPDX.format(spdx))
            own += [SPDX.format(f"{spdx}-{x}") for x in ("only", "or-later")] if "GPL" in spdx else []
    return {k: tuple(v) for k, v in out.items()}


TEMPLATES = templates()
#: In lower case; every template has one of them.
CUES: tuple[str, ...] = ("licens", "licenc", "copyright", "permission", "redistribut", "warrant", "public domain", "creative commons", "cc by", "cc0", "rights reserved", "free software", "gpl", "eupl", "anyone is free", "unauthorized copying")
