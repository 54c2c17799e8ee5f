"""Licence notices and short licence texts, as their authors publish them.

Fixed values, word for word.  A name that ends in a version, as ``-2.0``, makes
the version's numbers part of a match.
"""

from __future__ import annotations

_GNU_TERMS = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
              "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details.")
_GNU = ("This program is free software{2} you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software "
        "Foundation, {1}. " + _GNU_TERMS)
_LATER = "either version {} of the License, or (at your option) any later version"
_ONLY = "version {} of the License"
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_TWO = ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution. ")
_BSD_NAME = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission. ")
_BSD_WARRANTY = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
                 "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
                 "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
                 "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
                 "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
                 "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
              '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
              "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
              "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
              "Software. ")
_MIT_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
                 "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
                 "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                 "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial",
       "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_GNU_NAMES = {"gpl": ("GNU General Public License", ("2.0", "3.0")), "lgpl": ("GNU Lesser General Public License", ("2.1", "3.0")),
              "agpl": ("GNU Affero General Public License", ("3.0",))}


def _version(v: str) -> str:
    """As the GNU notices write it: 2.0 is 2."""
    return v.removesuffix(".0")


TEMPLATES = {
    # one-line notices
    "apache-line-2.0": "Licensed under the Apache License, Version 2.0",
    "mit-line": "Released under the MIT License",
    "cc-by-nc-line-4.0": "Licensed under CC BY-NC 4.0",
    **{f"gpl-line-{v}": f"This work is licensed under the GNU General Public License, version {_version(v)}" for v in ("2.0", "3.0")},
    # notices that name a licence
    **{f"{short}-or-later-{v}": _GNU.format(name, _LATER.format(_version(v)), ":" if v == "3.0" else ";")
       for short, (name, versions) in _GNU_NAMES.items() for v in versions},
    **{f"{short}-only-{v}": _GNU.format(name, _ONLY.format(_version(v)), ":" if v == "3.0" else ";")
       for short, (name, versions) in _GNU_NAMES.items() for v in versions},
    **{f"cc-{short}-4.0": f"This work is licensed under a Creative Commons {name} 4.0 International License." for short, name in _CC.items()},
    **{f"cc-{short}-3.0": f"This work is licensed under a Creative Commons {name} 3.0 Unported License." for short, name in _CC.items()},
    "apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
                   "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
                   "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "mpl-1.1": ('The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in '
                "compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed under the License "
                'is distributed on an "AS IS" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied.'),
    "epl-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
                "https://www.eclipse.org/legal/epl-2.0/"),
    "epl-1.0": ("All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
                "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "cc0-1.0": ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
                "public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain "
                "Dedication along with this software. If not, see http://creativecommons.org/publicdomain/zero/1.0/."),
    # whole licence texts
    "mit": _MIT_GRANT + _MIT_WARRANTY,
    "mit-grant": _MIT_GRANT,
    "mit-warranty": _MIT_WARRANTY,
    "bsd-2-clause": _REDISTRIBUTION + _BSD_TWO + _BSD_WARRANTY,
    "bsd-3-clause": _REDISTRIBUTION + _BSD_TWO + _BSD_NAME + _BSD_WARRANTY,
    "apache-software-1.1": (_REDISTRIBUTION + _BSD_TWO + "The end-user documentation included with the redistribution, if any, must include the following "
                            'acknowledgment: "This product includes software developed by the Apache Software Foundation (http://www.apache.org/)." Alternately, '
                            "this acknowledgment may appear in the software itself, if and wherever such third-party acknowledgments normally appear. The names "
                            '"Apache" and "Apache Software Foundation" must not be used to endorse or promote products derived from this software without prior '
                            'written permission. Products derived from this software may not be called "Apache", nor may "Apache" appear in their name, without '
                            "prior written permission of the Apache Software Foundation."),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
            "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
             "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
             "alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not "
             "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
             "software. This notice may not be removed or altered from any source distribution."),
    "unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
                  "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
                  "software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
                  "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
                  "under copyright law."),
}
