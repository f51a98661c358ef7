"""Licences as templates: what is said in a header, how a licence's own text opens, and whole short licences.

All are public texts.  Names are the usual short ones.
"""

from __future__ import annotations

# Sentences that put a file under a licence.
HEADERS: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache License 2.0.",
    ],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Licences that a tag "SPDX-License-Identifier" names; -only and -or-later are the same licence here.
TAGGED = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib")
# How the texts of long licences open.
OPENINGS: dict[str, list[str]] = {
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0 1. Definitions"],
}
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without"
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
    " conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_MIT_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
    " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR"
    " OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,"
    " this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution."
)
_BSD_THIRD = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR"
    " PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF"
    " SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY"
    " SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
    " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
    " purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public"
    " domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and"
    " future rights to this software under copyright law."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
    " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not"
    " claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly"
    " marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
# Short licences, whole and without their disclaimers.
BODIES: dict[str, list[str]] = {
    "BSD-2-Clause": [_BSD + _BSD_WARRANTY, _BSD],
    "BSD-3-Clause": [_BSD + _BSD_THIRD + _BSD_WARRANTY, _BSD + _BSD_THIRD],
    "ISC": ["ISC License " + _ISC],
    "MIT": ["MIT License " + _MIT + _MIT_WARRANTY, "MIT License " + _MIT],
    "Unlicense": [_UNLICENSE, _UNLICENSE + _MIT_WARRANTY],
    "Zlib": [_ZLIB],
}
