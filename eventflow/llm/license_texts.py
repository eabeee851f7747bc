"""Public licence texts and notices, by identifier; placeholders and copyright lines left out."""

WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + WARRANTY
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.\n"
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
    "from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must "
    "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.\n3. This notice may not be removed or altered from any source distribution."
)
APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
    "copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed "
    'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
    "the specific language governing permissions and limitations under the License."
)
MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
    "can obtain one at http://mozilla.org/MPL/2.0/."
)


def texts() -> list[tuple[str, str]]:
    """(identifier, text): full texts, and the usual notices made from names and versions."""
    out = [
        ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n" + ISC),
        ("BSD-2-Clause", BSD_START + BSD_END), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_START + BSD_END),
        ("BSD-3-Clause", BSD_START + BSD_NAME + BSD_END), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_START + BSD_NAME + BSD_END),
        ("Zlib", ZLIB), ("Apache-2.0", APACHE), ("MPL-2.0", MPL), ("all-rights-reserved", "All rights reserved."),
    ]
    named = {
        "MIT": ["MIT License"], "ISC": ["ISC License"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"],
        "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"], "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"],
        "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    }
    for v in ("2", "3"):
        named[f"GPL-{v}.0"] = [f"GNU General Public License, version {v}", f"GNU GPL v{v}", f"GPLv{v}"]
    for v in ("2.1", "3"):
        named[f"LGPL-{v}"] = [f"GNU Lesser General Public License, version {v}", f"LGPLv{v}"]
    named["AGPL-3.0"] = ["GNU Affero General Public License, version 3", "AGPLv3"]
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        named[f"CC-{kind}-4.0"] = [f"CC {kind} 4.0", f"CC-{kind}-4.0"]
    for name, forms in named.items():
        out.append((name, f"SPDX-License-Identifier: {name}"))
        for form in forms:
            for start in ("Licensed under", "Released under", "This work is licensed under", "Distributed under"):
                out += [(name, f"{start} {form}"), (name, f"{start} the {form}")]
    return out
