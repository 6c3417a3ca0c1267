"""Wording of public license notices, marked up for ``license_templates``.

Plain text is compared by its words, so case and punctuation are free.
``<<beginOptional>>`` ... ``<<endOptional>>`` may be absent, one of the wordings
of ``<<var;match=a|b>>`` must stand, and ``<<var;max=n>>`` stands for one to n
words (a holder's name).
"""

from __future__ import annotations

_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
<<beginOptional>> 1. <<endOptional>> Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
<<beginOptional>> 2. <<endOptional>> Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""

_BSD_NAMES = """
<<beginOptional>> 3. <<endOptional>> Neither the name of <<var;max=20>> nor the names of its
contributors may be used to endorse or promote products derived from this software without specific
prior written permission."""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY <<var;max=20>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL <<var;max=20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the Software), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions: The above copyright notice and this permission notice <<beginOptional>>
(including the next paragraph) <<endOptional>> shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
<<var;match=noninfringement|non infringement>>. IN NO EVENT SHALL <<var;max=20>> BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """
Permission to use, copy, modify, and <<beginOptional>> /or <<endOptional>> distribute this software for
any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND <<var;max=20>> DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL <<var;max=20>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_APACHE = """
Licensed under the Apache License, Version 2.0 (the License); you may not use this
<<var;match=file|software|work|program>> except in compliance with the License. You may obtain a copy
of the License at <<var;match=http|https>>://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an AS
IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""

_MPL = """
This Source Code Form is subject to the terms of the Mozilla Public License, <<var;match=v|version>>
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
<<var;match=http|https>>://mozilla.org/MPL/2.0"""


def _gnu(name: str, version: str) -> str:
    """The notice of the GNU licenses: they differ in name and version."""
    return f"""
is free software: you can redistribute it and/or modify it under the
terms of the GNU {name} License as published by the Free Software Foundation
<<var;match=; either version {version} of the License, or (at your option) any later version|; version
{version} of the License>>. <<var;max=8>> is distributed in the hope that it will
be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
A PARTICULAR PURPOSE. See the GNU {name} License for more details.
You should have received a copy of the GNU {name} License along with"""


#: (label, wording) of whole notices: conditions and disclaimers included.
NOTICES = (
    ("apache-2.0", _APACHE),
    ("bsd-2-clause", _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("isc", _ISC),
    ("mit", _MIT),
    ("mpl-2.0", _MPL),
    ("gpl-2.0", _gnu("General Public", "2")),
    ("gpl-3.0", _gnu("General Public", "3")),
    ("lgpl-2.1", _gnu("Lesser General Public", "2.1")),
    ("lgpl-3.0", _gnu("Lesser General Public", "3")),
    ("agpl-3.0", _gnu("Affero General Public", "3")),
)

_GNU = ("licensed under the <<beginOptional>> terms of the <<endOptional>> GNU General Public License "
        "<<beginOptional>> as published by the Free Software Foundation <<beginOptional>> either "
        "<<endOptional>> <<endOptional>> <<var;match=version|v>> ")

#: (label, wording) of one-sentence statements that name a license.
STATEMENTS = (
    ("apache-2.0", "licensed under the Apache <<beginOptional>> Software <<endOptional>> License "
                   "<<beginOptional>> Version <<endOptional>> 2.0"),
    ("cc-by-4.0", "licensed under <<beginOptional>> a <<endOptional>> <<beginOptional>> Creative Commons "
                  "<<endOptional>> <<var;match=CC|Attribution>> <<beginOptional>> BY <<endOptional>> 4.0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>> a <<endOptional>> CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>> a <<endOptional>> CC BY-SA 4.0"),
    ("gpl-2.0", _GNU + "2"),
    ("gpl-3.0", _GNU + "3"),
    ("mit", "<<var;match=released|licensed|distributed|available>> under the <<beginOptional>> terms of "
            "the <<endOptional>> MIT License"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License <<var;match=v|version>> 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
