"""Texts of licences, notices that stand for one, and digests of longer licences."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

ZERO_BSD = ISC.replace(
    """hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "hereby granted.",
)

BSD_TERMS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""

BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""

BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

# (identifier, title that may stand first, text)
TEXTS = [
    ("MIT", "MIT License", MIT),
    ("ISC", "ISC License", ISC),
    ("0BSD", "BSD Zero Clause License", ZERO_BSD),
    ("BSD-2-Clause", "BSD 2-Clause License", f"{BSD_TERMS}\n\n{BSD_WARRANTY}"),
    ("BSD-3-Clause", "BSD 3-Clause License", f"{BSD_TERMS}\n\n{BSD_NAMES}\n\n{BSD_WARRANTY}"),
    ("Zlib", "zlib License", ZLIB),
    ("MIT", "", "Released under the MIT License."),
    ("Apache-2.0", "", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "", "Licensed under CC BY-NC 4.0."),
]

# Digests of the canonical form of licences too long to print here.
DIGESTS = {
    "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b": "Apache-2.0",
    "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a": "GPL-1.0",
    "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6": "GPL-2.0",
    "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68": "GPL-3.0",
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0",
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1": "MPL-1.1",
    "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a": "MPL-2.0",
    "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71": "GFDL-1.2",
    "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6": "GFDL-1.3",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702": "Artistic-1.0-Perl",
}
