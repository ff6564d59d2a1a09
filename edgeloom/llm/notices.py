"""Licence notices to look for: headers, grants, conditions, disclaimers and one-line notices, with SPDX ids.

Notices of one family are told apart by the share of them that a text holds: versions of a header differ in
a word or two, and some grants begin like others.
"""

from __future__ import annotations

#: The wording of widespread licence notices, as (name, SPDX id, family, text).
NOTICES = (
    ("GPL-3.0-notice", "GPL-3.0-only", "gpl-line", "This work is licensed under the GNU General Public License, version 3."),
    ("all-rights-reserved", "LicenseRef-all-rights-reserved", "reserved", "All rights reserved."),
    ("CC-BY-NC-4.0-notice", "CC-BY-NC-4.0", "cc-line", "Licensed under CC BY-NC 4.0."),
    ("MIT-notice", "MIT", "mit-line", "Released under the MIT License."),
    ("Apache-2.0-notice", "Apache-2.0", "apache", "Licensed under the Apache License, Version 2.0."),
    ("MIT-grant", "MIT", "grant", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    )),
    ("BSD-conditions", "BSD-2-Clause", "bsd", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    )),
    ("GPL-or-later-header", "GPL-3.0-or-later", "gpl-header", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    )),
    ("Apache-2.0-header", "Apache-2.0", "apache", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."
    )),
    ("MIT-licensed-notice", "MIT", "mit-line", "Licensed under the MIT License."),
    ("MIT-distributed-notice", "MIT", "mit-line", "Distributed under the MIT License."),
    ("MIT-terms-notice", "MIT", "mit-line", "under the terms of the MIT License"),
    ("MIT-title", "MIT", "mit-line", "The MIT License (MIT)"),
    ("MIT-conditions", "MIT", "mit-conditions", (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    )),
    ("MIT-disclaimer", "MIT", "disclaimer", (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    )),
    ("BSD-3-Clause-notice", "BSD-3-Clause", "bsd-line", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause-notice", "BSD-2-Clause", "bsd-line", "Licensed under the BSD 2-Clause License."),
    ("BSD-style-notice", "BSD-3-Clause", "bsd-line", (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    )),
    ("BSD-3-Clause-endorsement", "BSD-3-Clause", "bsd", (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY"
    )),
    ("BSD-binary-condition", "BSD-2-Clause", "bsd", (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    )),
    ("BSD-disclaimer", "BSD-2-Clause", "bsd", (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    )),
    ("Apache-2.0-plain-notice", "Apache-2.0", "apache", "Licensed under the Apache License 2.0."),
    ("Apache-2.0-title", "Apache-2.0", "apache-title", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0-disclaimer", "Apache-2.0", "apache-disclaimer", (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."
    )),
    ("ASF-grant", "Apache-2.0", "asf", (
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements."
    )),
    ("GPL-2.0-notice", "GPL-2.0-only", "gpl-line", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-short-notice", "GPL-3.0-only", "gpl-line", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0-short-notice", "GPL-2.0-only", "gpl-line", "Licensed under the GNU General Public License v2.0."),
    ("AGPL-3.0-short-notice", "AGPL-3.0-only", "gpl-line", "Licensed under the GNU Affero General Public License v3.0."),
    ("LGPL-3.0-short-notice", "LGPL-3.0-only", "gpl-line", "Licensed under the GNU Lesser General Public License v3.0."),
    ("GPL-2.0-or-later-header", "GPL-2.0-or-later", "gpl-header", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version."
    )),
    ("GPL-2.0-only-header", "GPL-2.0-only", "gpl-header", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License version 2 as published by the Free Software Foundation."
    )),
    ("LGPL-2.1-or-later-header", "LGPL-2.1-or-later", "gpl-header", (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    )),
    ("LGPL-3.0-or-later-header", "LGPL-3.0-or-later", "gpl-header", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    )),
    ("AGPL-3.0-or-later-header", "AGPL-3.0-or-later", "gpl-header", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    )),
    ("GPL-disclaimer", "LicenseRef-GPL-family", "gpl-disclaimer", (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details."
    )),
    ("LGPL-disclaimer", "LicenseRef-LGPL-family", "gpl-disclaimer", (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details."
    )),
    ("GPL-preamble", "LicenseRef-GPL-family", "gpl-preamble", (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works."
    )),
    ("AGPL-3.0-preamble", "AGPL-3.0-only", "gpl-preamble", (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."
    )),
    ("MPL-2.0-header", "MPL-2.0", "mpl", (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    )),
    ("MPL-2.0-notice", "MPL-2.0", "mpl", "Licensed under the Mozilla Public License 2.0."),
    ("ISC-grant", "ISC", "isc", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    )),
    ("0BSD-grant", "0BSD", "isc", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted."
    )),
    ("ISC-disclaimer", "ISC", "disclaimer", (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    )),
    ("ISC-notice", "ISC", "isc-line", "Licensed under the ISC License."),
    ("Unlicense", "Unlicense", "unlicense", (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    )),
    ("CC0-dedication", "CC0-1.0", "cc0", (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."
    )),
    ("CC0-notice", "CC0-1.0", "cc0", "Licensed under CC0 1.0 Universal."),
    ("public-domain-notice", "LicenseRef-public-domain", "public-domain", "This work has been released into the public domain."),
    ("Zlib-grant", "Zlib", "zlib", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely"
    )),
    ("BSL-1.0-grant", "BSL-1.0", "grant", (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
        "to whom the Software is furnished to do so"
    )),
    ("EPL-2.0-header", "EPL-2.0", "epl", (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
    )),
    ("EPL-1.0-header", "EPL-1.0", "epl", (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"
    )),
    ("PostgreSQL-grant", "PostgreSQL", "postgresql", (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, "
        "and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph "
        "and the following two paragraphs appear in all copies."
    )),
    ("PSF-2.0-agreement", "PSF-2.0", "psf", (
        "This LICENSE AGREEMENT is between the Python Software Foundation (\"PSF\"), and the Individual or Organization "
        "(\"Licensee\") accessing and otherwise using this software in source or binary form and its associated documentation."
    )),
    ("OFL-1.1-notice", "OFL-1.1", "ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CDDL-1.0-header", "CDDL-1.0", "cddl", (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the "
        "\"License\"). You may not use this file except in compliance with the License."
    )),
    ("EUPL-1.2-header", "EUPL-1.2", "eupl", (
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent "
        "versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence."
    )),
    ("MS-PL-title", "MS-PL", "ms-pl", "Microsoft Public License (Ms-PL)"),
    ("Elastic-2.0-notice", "Elastic-2.0", "elastic", "Licensed under the Elastic License 2.0."),
)

#: The Creative Commons licences, by their short and their long name.
CREATIVE_COMMONS = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
#: Ids that are looked for behind the tag of SPDX; none begins like another.
TAGGED = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "MPL-2.0", "ISC",
)


def notices() -> list[tuple[str, str, str, str]]:
    """All notices as (name, SPDX id, family, text), each name once."""
    lines = list(NOTICES)
    known = {text for *_, text in lines}
    for short, long in CREATIVE_COMMONS:
        spdx = f"CC-{short}-4.0"
        lines.append((f"{spdx}-line", spdx, "cc-line", f"Licensed under CC {short} 4.0."))
        lines.append((f"{spdx}-long", spdx, "cc-long", f"This work is licensed under a Creative Commons {long} 4.0 International License."))
    lines += [(f"{x}-tag", x, "tag", f"SPDX-License-Identifier: {x}") for x in TAGGED]
    return [x for k, x in enumerate(lines) if k < len(NOTICES) or x[3] not in known]
