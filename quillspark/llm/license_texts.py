"""License texts and one-sentence notices, by SPDX id, as their publishers word them."""

MIT = """MIT License

Copyright (c) 2020 Holder

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

ISC = """ISC License

Copyright (c) 2020 Holder

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

ZERO_BSD = """BSD Zero Clause License

Copyright (c) 2020 Holder

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
BSD_2 = "BSD 2-Clause License\n\nCopyright (c) 2020, Holder\n\n" + _BSD_TERMS + _BSD_DISCLAIMER
BSD_3 = "BSD 3-Clause License\n\nCopyright (c) 2020, Holder\n\n" + _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER

ZLIB = """zlib License

Copyright (c) 2020 Holder

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>
"""


def untitled(text: str) -> str:
    """The text without the line that names the license."""
    return text.split("\n", 1)[1]


TEXTS: dict[str, tuple[str, ...]] = {
    "MIT": (MIT, untitled(MIT), "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "ISC": (ISC, untitled(ISC), "SPDX-License-Identifier: ISC"),
    "0BSD": (ZERO_BSD, untitled(ZERO_BSD), "SPDX-License-Identifier: 0BSD"),
    "BSD-2-Clause": (BSD_2, untitled(BSD_2), "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (BSD_3, untitled(BSD_3), "SPDX-License-Identifier: BSD-3-Clause"),
    "Zlib": (ZLIB, untitled(ZLIB), "SPDX-License-Identifier: Zlib"),
    "Unlicense": (UNLICENSE, "SPDX-License-Identifier: Unlicense"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0-only": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
}

#: SHA-256 of the form by which licenses are looked up (licenses.look_up_text), of texts too long for this file, as Debian's
#: base-files has them: whole and, if the terms have a marked end, without what follows it, with and without the mark.
DIGESTS: dict[str, str] = {
    "95f35d79ea3bab75c250549d6a03cef242e0547d78c99e26fcede49936fb0184": "Apache-2.0",
    "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0": "Apache-2.0",
    "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a": "Apache-2.0",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0-only",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0-only",
    "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70": "GPL-1.0-only",
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0-only",
    "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34": "GPL-2.0-only",
    "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808": "GPL-2.0-only",
    "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a": "GPL-3.0-only",
    "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636": "GPL-3.0-only",
    "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191": "GPL-3.0-only",
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0-only",
    "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260": "LGPL-2.0-only",
    "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2": "LGPL-2.0-only",
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1-only",
    "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4": "LGPL-2.1-only",
    "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df": "LGPL-2.1-only",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0-only",
    "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6": "MPL-1.1",
    "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a": "MPL-2.0",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b": "GFDL-1.2-only",
    "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d": "GFDL-1.3-only",
}
