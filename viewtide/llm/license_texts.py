"""Public license texts and phrases, in lower-case words."""

# The phrases that the contract labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this
software and associated documentation files the software to deal in the software without
restriction including without limitation the rights to use copy modify merge publish distribute
sublicense and or sell copies of the software and to permit persons to whom the software is
furnished to do so subject to the following conditions the above copyright notice and this
permission notice shall be included in all copies or substantial portions of the software the
software is provided as is without warranty of any kind express or implied including but not
limited to the warranties of merchantability fitness for a particular purpose and noninfringement
in no event shall the authors or copyright holders be liable for any claim damages or other
liability whether in an action of contract tort or otherwise arising from out of or in connection
with the software or the use or other dealings in the software"""

_ISC = """permission to use copy modify and or distribute this software for any purpose with or
without fee is hereby granted provided that the above copyright notice and this permission notice
appear in all copies the software is provided as is and the author disclaims all warranties with
regard to this software including all implied warranties of merchantability and fitness in no
event shall the author be liable for any special direct indirect or consequential damages or any
damages whatsoever resulting from loss of use data or profits whether in an action of contract
negligence or other tortious action arising out of or in connection with the use or performance of
this software"""

_BSD = """redistribution and use in source and binary forms with or without modification are
permitted provided that the following conditions are met 1 redistributions of source code must
retain the above copyright notice this list of conditions and the following disclaimer 2
redistributions in binary form must reproduce the above copyright notice this list of conditions
and the following disclaimer in the documentation and or other materials provided with the
distribution 3 neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission this software is provided by the copyright holders and contributors as is and any
express or implied warranties including but not limited to the implied warranties of
merchantability and fitness for a particular purpose are disclaimed in no event shall the
copyright holder or contributors be liable for any direct indirect incidental special exemplary or
consequential damages including but not limited to procurement of substitute goods or services
loss of use data or profits or business interruption however caused and on any theory of liability
whether in contract strict liability or tort including negligence or otherwise arising in any way
out of the use of this software even if advised of the possibility of such damage"""

_ZLIB = """this software is provided as is without any express or implied warranty in no event
will the authors be held liable for any damages arising from the use of this software permission
is granted to anyone to use this software for any purpose including commercial applications and to
alter it and redistribute it freely subject to the following restrictions 1 the origin of this
software must not be misrepresented you must not claim that you wrote the original software if you
use this software in a product an acknowledgment in the product documentation would be appreciated
but is not required 2 altered source versions must be plainly marked as such and must not be
misrepresented as being the original software 3 this notice may not be removed or altered from any
source distribution"""

# Label, mandatory key phrase, notice or whole text.
TEMPLATES = (
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "gnu affero general public license", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "permission is hereby granted free of charge", _MIT),
    ("mit", "mit license", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistribution and use in source and binary forms", _BSD),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "permission to use copy modify", _ISC),
    ("zlib", "without any express or implied warranty", _ZLIB),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc0", "cc0 1 0", "to the extent possible under law the author has waived all copyright under cc0 1 0 universal"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
)
