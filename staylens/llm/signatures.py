"""License signatures, best kind first: what the text says, what it names.

One signature a line: its label and a regular expression over lower-cased text
in a short notation. A blank stands for a gap between words (white space, marks of
comments and quotes), `_` for nothing, a blank or a hyphen, `<2>` for a version
however it is introduced, with or without `.0`, `<2.1>` for exactly that one.
`{l}` is license or licence, `{u}` words that grant, `{later}` words that admit
later versions, `{spdx}` the tag before an identifier. Signatures begin and end
at words. Where a part is named `at`, that part is the detection and the rest
what must stand around it.
"""

from __future__ import annotations

import re

MACROS = {
    "{l}": r"licen[sc]es?",
    "{u}": r"(?:licensed|released|distributed|redistributed|published|available|provided|covered|dual_licensed) under (?:the )?(?:terms of )?(?:the )?",
    "{later}": r"(?:\+|_or_later| or (?:at your option )?(?:any )?(?:later|newer)(?: version)?)",
    "{spdx}": r"spdx-license-identifier[\s:(]+",
}
GAP = r"""[\s,;:"'()*#/-]+"""
HEAD = r"[\s,;(/-]*(?:version\s+|ver\.?\s*|v\.?\s*)?"

SPDX = r"""
0bsd {spdx}0bsd
afl-3.0 {spdx}afl-3\.0
agpl-3 {spdx}agpl-3\.0(?:-only)?
agpl-3-or-later {spdx}agpl-3\.0(?:-or-later|\+)
apache-1 {spdx}apache-1\.0
apache-1.1 {spdx}apache-1\.1
apache-2 {spdx}apache-2\.0
apache-2-llvm {spdx}apache-2\.0 with llvm-exception
artistic-1.0 {spdx}artistic-1\.0
artistic-2.0 {spdx}artistic-2\.0
blueoak-1.0 {spdx}blueoak-1\.0\.0
boost-1.0 {spdx}bsl-1\.0
bsd-2-clause {spdx}bsd-2-clause
bsd-3-clause {spdx}bsd-3-clause
bsd-4-clause {spdx}bsd-4-clause
busl-1.1 {spdx}busl-1\.1
cc-by-1.0 {spdx}cc-by-1\.0
cc-by-2.0 {spdx}cc-by-2\.0
cc-by-3.0 {spdx}cc-by-3\.0
cc-by-4.0 {spdx}cc-by-4\.0
cc-by-sa-3.0 {spdx}cc-by-sa-3\.0
cc-by-sa-4.0 {spdx}cc-by-sa-4\.0
cc-by-nd-4.0 {spdx}cc-by-nd-4\.0
cc-by-nc-3.0 {spdx}cc-by-nc-3\.0
cc-by-nc-4.0 {spdx}cc-by-nc-4\.0
cc-by-nc-sa-4.0 {spdx}cc-by-nc-sa-4\.0
cc-by-nc-nd-4.0 {spdx}cc-by-nc-nd-4\.0
cc0-1.0 {spdx}cc0-1\.0
cddl-1.0 {spdx}cddl-1\.0
cddl-1.1 {spdx}cddl-1\.1
cecill-2.1 {spdx}cecill-2\.1
ecl-2.0 {spdx}ecl-2\.0
epl-1.0 {spdx}epl-1\.0
epl-2.0 {spdx}epl-2\.0
eupl-1.1 {spdx}eupl-1\.1
eupl-1.2 {spdx}eupl-1\.2
fsl-1.1 {spdx}fsl-1\.1-(?:mit|apache-2\.0)
gfdl-1.3 {spdx}gfdl-1\.3(?:-only|-or-later)?
gpl-1 {spdx}gpl-1\.0(?:-only)?
gpl-1-or-later {spdx}gpl-1\.0(?:-or-later|\+)
gpl-2 {spdx}gpl-2\.0(?:-only)?
gpl-2-or-later {spdx}gpl-2\.0(?:-or-later|\+)
gpl-2-classpath {spdx}gpl-2\.0(?:-only|-or-later)? with classpath-exception-2\.0
gpl-2-linux-syscall {spdx}gpl-2\.0(?:-only|-or-later|\+)? with linux-syscall-note
gpl-3 {spdx}gpl-3\.0(?:-only)?
gpl-3-or-later {spdx}gpl-3\.0(?:-or-later|\+)
hpnd {spdx}hpnd
isc {spdx}isc
lgpl-2 {spdx}lgpl-2\.0(?:-only)?
lgpl-2-or-later {spdx}lgpl-2\.0(?:-or-later|\+)
lgpl-2.1 {spdx}lgpl-2\.1(?:-only)?
lgpl-2.1-or-later {spdx}lgpl-2\.1(?:-or-later|\+)
lgpl-3 {spdx}lgpl-3\.0(?:-only)?
lgpl-3-or-later {spdx}lgpl-3\.0(?:-or-later|\+)
mit {spdx}mit
mit-0 {spdx}mit-0
mpl-1.1 {spdx}mpl-1\.1
mpl-2.0 {spdx}mpl-2\.0
ms-pl {spdx}ms-pl
ms-rl {spdx}ms-rl
mulanpsl-2.0 {spdx}mulanpsl-2\.0
ncsa {spdx}ncsa
odbl-1.0 {spdx}odbl-1\.0
ofl-1.1 {spdx}ofl-1\.1
osl-3.0 {spdx}osl-3\.0
postgresql {spdx}postgresql
psf-2 {spdx}(?:psf-2\.0|python-2\.0)
sspl-1.0 {spdx}sspl-1\.0
unicode-3.0 {spdx}unicode-3\.0
unlicense {spdx}unlicense
upl-1.0 {spdx}upl-1\.0
vim {spdx}vim
w3c {spdx}w3c
wtfpl {spdx}wtfpl
zlib {spdx}zlib
zpl-2.1 {spdx}zpl-2\.1
"""

NOTICES = r"""
agpl the terms of the gnu affero general public {l}
agpl-3 gnu affero general public {l} as published by the free software foundation (?:either )?version 3
agpl-3-or-later gnu affero general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
agpl-3-or-later this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
gpl-2-or-later this program is free software you can redistribute it and or modify it under the terms of the gnu general public {l} as published by the free software foundation either version 2 of the {l} or (?:at your option )?any later version
gpl-3-or-later this program is free software you can redistribute it and or modify it under the terms of the gnu general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
lgpl-2.1-or-later this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public {l} as published by the free software foundation either version 2\.1 of the {l} or (?:at your option )?any later version
lgpl-3-or-later this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
apache-2 licensed under the apache {l}<2>(?: the {l})?
apache-2 you may not use this file except in compliance with the {l} you may obtain a copy of the {l} at https?: www\.apache\.org licenses license-2\.0
apache-2 https?://(?:www\.)?apache\.org/licenses/license-2\.0(?:\.txt|\.html)?
apache-1.1 this product includes software developed by the apache software foundation
artistic this package is free software you can redistribute it and or modify it under the same terms as perl(?: itself)?
boost-1.0 boost software {l} - version 1\.0
boost-1.0 distributed under the boost software {l}<1>
boost-1.0 https?://(?:www\.)?boost\.org/license_1_0\.txt
bsd redistribution and use in source and binary forms with or without modification are permitted
bsd redistributions of source code must retain the above copyright notice
bsd redistributions in binary form must reproduce the above copyright notice
bsd redistribution and use in source and binary forms
bsd-3-clause neither the name of \S+(?: \S+)?(?: \S+)?(?: \S+)?(?: \S+)?(?: \S+)? may be used to endorse or promote products
bsd-4-clause all advertising materials mentioning features or use of this software must display
bsd use of this source code is governed by a bsd_style {l}
cc0 to the extent possible under law
cc0 has waived all copyright and related or neighboring rights
cc0-1.0 https?://creativecommons\.org/publicdomain/zero/1\.0
public-domain https?://creativecommons\.org/publicdomain/mark/1\.0
cddl the contents of this file are subject to the terms of the common development and distribution {l}
epl this program and the accompanying materials are made available under the terms of the eclipse public {l}
epl-1.0 terms of the eclipse public {l} v1\.0
epl-2.0 terms of the eclipse public {l}<2>
epl-1.0 https?://(?:www\.)?eclipse\.org/legal/epl-v10(?:\.html)?
epl-2.0 https?://(?:www\.)?eclipse\.org/legal/epl-(?:2\.0|v20)
eupl licensed under the eupl
eupl-1.2 licensed under the eupl<1.2>
gfdl permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {l}
gfdl-1.2 gnu free documentation {l} version 1\.2
gfdl-1.3 gnu free documentation {l} version 1\.3
gpl this program is free software you can redistribute it and or modify it
gpl this program is free software
gpl you should have received a copy of the gnu general public {l}
gpl-2 gnu general public {l} as published by the free software foundation (?:either )?version 2
gpl-2-or-later gnu general public {l} as published by the free software foundation either version 2 of the {l} or (?:at your option )?any later version
gpl-3 gnu general public {l} as published by the free software foundation (?:either )?version 3
gpl-3-or-later gnu general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
gpl-2 https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3 https?://(?:www\.)?gnu\.org/licenses/gpl-3\.0
agpl-3 https?://(?:www\.)?gnu\.org/licenses/agpl-3\.0
lgpl-2.1 https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3 https?://(?:www\.)?gnu\.org/licenses/lgpl-3\.0
isc permission to use copy modify and(?: or)? distribute this software
isc permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
lgpl this library is free software you can redistribute it and or modify it
lgpl you should have received a copy of the gnu (?:lesser|library) general public {l}
lgpl-2-or-later gnu library general public {l} as published by the free software foundation either version 2 of the {l} or (?:at your option )?any later version
lgpl-2.1 gnu lesser general public {l} as published by the free software foundation (?:either )?version 2\.1
lgpl-2.1-or-later gnu lesser general public {l} as published by the free software foundation either version 2\.1 of the {l} or (?:at your option )?any later version
lgpl-3 gnu lesser general public {l} as published by the free software foundation (?:either )?version 3
lgpl-3-or-later gnu lesser general public {l} as published by the free software foundation either version 3 of the {l} or (?:at your option )?any later version
mit permission is hereby granted free of charge to any person
mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit https?://(?:www\.)?opensource\.org/licen[sc]es/mit(?:-license\.php)?
mpl-1.1 the contents of this file are subject to the mozilla public {l} version 1\.1
mpl-2.0 this source code form is subject to the terms of the mozilla public {l}<2>
mpl-2.0 https?://(?:www\.)?mozilla\.org/mpl/2\.0
ncsa university of illinois ncsa open source {l}
odbl-1.0 https?://(?:www\.)?opendatacommons\.org/licenses/odbl/1(?:\.|-)0
ofl-1.1 this font software is licensed under the sil open font {l}<1.1>
ofl https?://scripts\.sil\.org/ofl
php-3.01 this source file is subject to version 3\.01 of the php {l}
public-domain this is free and unencumbered software released into the public domain
unlicense anyone is free to copy modify publish use compile sell or distribute this software
unlicense https?://(?:www\.)?unlicense\.org
public-domain (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain this (?:work|file|code|software) is in the public domain
wtfpl do what the f\S+ you want to public {l}
zlib this software is provided as-is without any express or implied warranty in no event will the authors be held liable
zlib permission is granted to anyone to use this software for any purpose including commercial applications
"""

GRANTS = r"""
agpl {u}(?:gnu )?(?:agpl|affero general public {l})
agpl-3 {u}(?:gnu )?(?:agpl|affero general public {l})<3>
agpl-3-or-later {u}(?:gnu )?(?:agpl|affero general public {l})<3>{later}
apache {u}apache(?: software)?(?: {l})?
apache-1.1 {u}apache(?: software)?(?: {l})?<1.1>
apache-2 {u}apache(?: software)?(?: {l})?<2>
artistic {u}artistic {l}
artistic-2.0 {u}artistic {l}<2>
boost {u}boost(?: software)? {l}
boost-1.0 {u}boost(?: software)? {l}<1>
bsd {u}(?:simplified |modified |new |revised )?bsd(?: {l})?
bsd-2-clause {u}(?:2|two)_clause bsd(?: {l})?
bsd-3-clause {u}(?:3|three)_clause bsd(?: {l})?
bsd-2-clause {u}bsd_(?:2|two)_clause(?: {l})?
bsd-3-clause {u}bsd_(?:3|three)_clause(?: {l})?
cc0 {u}creative commons zero(?: {l})?
cc0 {u}cc_0
cc {u}(?:a )?creative commons(?: {l})?
cddl {u}(?:cddl|common development and distribution {l})
cddl-1.0 {u}(?:cddl|common development and distribution {l})<1>
epl {u}(?:epl|eclipse public {l})
epl-1.0 {u}(?:epl|eclipse public {l})<1>
epl-2.0 {u}(?:epl|eclipse public {l})<2>
eupl {u}(?:eupl|european union public {l})
eupl-1.2 {u}(?:eupl|european union public {l})<1.2>
gfdl {u}(?:gfdl|gnu free documentation {l})
gpl {u}(?:gnu )?(?:gpl|general public {l})
gpl-1 {u}(?:gnu )?(?:gpl|general public {l})<1>
gpl-2 {u}(?:gnu )?(?:gpl|general public {l})<2>
gpl-2-or-later {u}(?:gnu )?(?:gpl|general public {l})<2>{later}
gpl-3 {u}(?:gnu )?(?:gpl|general public {l})<3>
gpl-3-or-later {u}(?:gnu )?(?:gpl|general public {l})<3>{later}
isc {u}isc(?: {l})?
lgpl {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})
lgpl-2 {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})<2>
lgpl-2.1 {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})<2.1>
lgpl-2.1-or-later {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})<2.1>{later}
lgpl-3 {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})<3>
lgpl-3-or-later {u}(?:gnu )?(?:lgpl|(?:lesser|library) general public {l})<3>{later}
mit {u}(?:mit|expat|x11)
mit {u}(?:mit|expat|x11) {l}
mpl {u}(?:mpl|mozilla public {l})
mpl-1.1 {u}(?:mpl|mozilla public {l})<1.1>
mpl-2.0 {u}(?:mpl|mozilla public {l})<2>
ms-pl {u}(?:ms-pl|microsoft public {l})
odbl {u}(?:odbl|open database {l})
ofl {u}(?:ofl|(?:sil )?open font {l})
osl-3.0 {u}(?:osl|open software {l})<3>
postgresql {u}postgresql {l}
psf {u}(?:psf|python software foundation)(?: {l})?
sspl {u}(?:sspl|server side public {l})
unlicense {u}unlicense
wtfpl {u}wtfpl
zlib {u}zlib(?: libpng)?(?: {l})?
mit same {l} as \S+ mit
proprietary {u}(?:a )?(?:proprietary|commercial) {l}
"""

NAMES = r"""
0bsd zero_clause bsd(?: {l})?
agpl gnu affero general public {l}
agpl affero general public {l}
agpl agpl {l}
agpl-3 (?:gnu )?(?:affero general public {l}|agpl(?: {l})?)<3>
agpl-3-or-later (?:gnu )?(?:affero general public {l}|agpl(?: {l})?)<3>{later}
apache apache(?: software)? licen[sc]e
apache-1 apache(?: software)? licen[sc]e<1>
apache-1.1 apache(?: software)? licen[sc]e<1.1>
apache-2 apache(?: software)? licen[sc]e<2>
artistic artistic licen[sc]e
artistic-1.0 artistic licen[sc]e<1>
artistic-2.0 artistic licen[sc]e<2>
beerware beer_?ware licen[sc]e
blueoak-1.0 blue oak model licen[sc]e<1.0.0>
boost boost software licen[sc]e
boost-1.0 boost software licen[sc]e<1>
bsd bsd licen[sc]e
bsd bsd_style licen[sc]e
bsd-2-clause (?:2|two)_clause bsd(?: licen[sc]e)?
bsd-2-clause bsd_(?:2|two)_clause(?: licen[sc]e)?
bsd-2-clause (?:simplified|freebsd) bsd licen[sc]e
bsd-3-clause (?:3|three)_clause bsd(?: licen[sc]e)?
bsd-3-clause bsd_(?:3|three)_clause(?: licen[sc]e)?
bsd-3-clause (?:modified|new|revised) bsd licen[sc]e
bsd-4-clause (?:4|four)_clause bsd(?: licen[sc]e)?
bsd-4-clause bsd_(?:4|four)_clause(?: licen[sc]e)?
busl-1.1 business source licen[sc]e<1.1>
cc0 creative commons zero
cc0 cc zero
cc0-1.0 (?:creative commons zero|cc_0)<1.0>(?: universal)?
cddl common development and distribution licen[sc]e
cddl-1.0 (?:common development and distribution licen[sc]e|cddl)<1>
cddl-1.1 (?:common development and distribution licen[sc]e|cddl)<1.1>
cecill cecill(?:-[abc])? licen[sc]e
commons-clause commons clause licen[sc]e condition
elastic-2.0 elastic licen[sc]e<2>
epl eclipse public licen[sc]e
epl-1.0 (?:eclipse public licen[sc]e|epl)<1>
epl-2.0 (?:eclipse public licen[sc]e|epl)<2>
eupl european union public licen[sc]e
eupl-1.1 (?:european union public licen[sc]e|eupl)<1.1>
eupl-1.2 (?:european union public licen[sc]e|eupl)<1.2>
gfdl gnu free documentation licen[sc]e
gpl gnu general public licen[sc]e
gpl gnu gpl
gpl gpl licen[sc]e
gpl-1 (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<1>
gpl-1-or-later (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<1>{later}
gpl-2 (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<2>
gpl-2-or-later (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<2>{later}
gpl-3 (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<3>
gpl-3-or-later (?:gnu )?(?:general public licen[sc]e|gpl(?: licen[sc]e)?)<3>{later}
isc isc licen[sc]e
json the json licen[sc]e
lgpl gnu (?:lesser|library) general public licen[sc]e
lgpl (?:gnu )?lgpl licen[sc]e
lgpl gnu lgpl
lgpl-2 (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<2>
lgpl-2-or-later (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<2>{later}
lgpl-2.1 (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<2.1>
lgpl-2.1-or-later (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<2.1>{later}
lgpl-3 (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<3>
lgpl-3-or-later (?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?: licen[sc]e)?)<3>{later}
lppl latex project public licen[sc]e
mit mit licen[sc]e
mit mit x11 licen[sc]e
mit expat licen[sc]e
mit-0 mit no attribution(?: licen[sc]e)?
mpl mozilla public licen[sc]e
mpl-1.0 (?:mozilla public licen[sc]e|mpl)<1>
mpl-1.1 (?:mozilla public licen[sc]e|mpl)<1.1>
mpl-2.0 (?:mozilla public licen[sc]e|mpl)<2>
ms-pl microsoft public licen[sc]e
ms-rl microsoft reciprocal licen[sc]e
mulanpsl mulan permissive software licen[sc]e
odbl open database licen[sc]e
odbl-1.0 (?:open database licen[sc]e|odbl)<1>
ofl (?:sil )?open font licen[sc]e
ofl-1.1 (?:(?:sil )?open font licen[sc]e|ofl)<1.1>
ogl-3.0 open government licen[sc]e<3>
openrail (?:creativeml )?open rail(?:-m)? licen[sc]e
osl open software licen[sc]e
osl-3.0 (?:open software licen[sc]e|osl)<3>
postgresql postgresql licen[sc]e
psf python software foundation licen[sc]e
psf-2 (?:python software foundation|psf) licen[sc]e<2>
sspl server side public licen[sc]e
sspl-1.0 server side public licen[sc]e<1>
unlicense the unlicense
upl-1.0 universal permissive licen[sc]e<1>
vim vim licen[sc]e
w3c w3c software (?:notice and )?licen[sc]e
wtfpl do what the f\S+ you want
zlib zlib(?: libpng)? licen[sc]e
zpl zope public licen[sc]e
cc-by-1.0 (?:cc_by|creative commons attribution|creativecommons\.org licenses by)<1.0>
cc-by-2.0 (?:cc_by|creative commons attribution|creativecommons\.org licenses by)<2.0>
cc-by-2.5 (?:cc_by|creative commons attribution|creativecommons\.org licenses by)<2.5>
cc-by-3.0 (?:cc_by|creative commons attribution|creativecommons\.org licenses by)<3.0>
cc-by-4.0 (?:cc_by|creative commons attribution|creativecommons\.org licenses by)<4.0>
cc-by (?:cc_by|creative commons attribution|creativecommons\.org licenses by)
cc-by-sa-1.0 (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)<1.0>
cc-by-sa-2.0 (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)<2.0>
cc-by-sa-2.5 (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)<2.5>
cc-by-sa-3.0 (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)<3.0>
cc-by-sa-4.0 (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)<4.0>
cc-by-sa (?:cc_by_sa|creative commons attribution share_alike|creativecommons\.org licenses by-sa)
cc-by-nd-3.0 (?:cc_by_nd|creative commons attribution no_deriv(?:ative)?s?(?: works)?|creativecommons\.org licenses by-nd)<3.0>
cc-by-nd-4.0 (?:cc_by_nd|creative commons attribution no_deriv(?:ative)?s?(?: works)?|creativecommons\.org licenses by-nd)<4.0>
cc-by-nd (?:cc_by_nd|creative commons attribution no_deriv(?:ative)?s?(?: works)?|creativecommons\.org licenses by-nd)
cc-by-nc-1.0 (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)<1.0>
cc-by-nc-2.0 (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)<2.0>
cc-by-nc-2.5 (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)<2.5>
cc-by-nc-3.0 (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)<3.0>
cc-by-nc-4.0 (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)<4.0>
cc-by-nc (?:cc_by_nc|creative commons attribution non_commercial|creativecommons\.org licenses by-nc)
cc-by-nc-sa-3.0 (?:cc_by_nc_sa|creative commons attribution non_commercial share_alike|creativecommons\.org licenses by-nc-sa)<3.0>
cc-by-nc-sa-4.0 (?:cc_by_nc_sa|creative commons attribution non_commercial share_alike|creativecommons\.org licenses by-nc-sa)<4.0>
cc-by-nc-sa (?:cc_by_nc_sa|creative commons attribution non_commercial share_alike|creativecommons\.org licenses by-nc-sa)
cc-by-nc-nd-3.0 (?:cc_by_nc_nd|creative commons attribution non_commercial no_deriv(?:ative)?s?|creativecommons\.org licenses by-nc-nd)<3.0>
cc-by-nc-nd-4.0 (?:cc_by_nc_nd|creative commons attribution non_commercial no_deriv(?:ative)?s?|creativecommons\.org licenses by-nc-nd)<4.0>
cc-by-nc-nd (?:cc_by_nc_nd|creative commons attribution non_commercial no_deriv(?:ative)?s?|creativecommons\.org licenses by-nc-nd)
"""

SHORT = r"""
apache-2 apache_2\.0
apache-2 asl 2\.0
mit (?:apache_2\.0|bsd|gpl|lgpl|mpl|isc|unlicense) (?:or|and) (?P<at>mit)
mit (?P<at>mit) (?:or|and) (?:apache|bsd|gpl|lgpl|mpl|isc|unlicense|zlib)
isc (?P<at>isc) (?:or|and) (?:apache|bsd|gpl|mit)
isc (?:apache_2\.0|bsd|gpl|lgpl|mpl|mit) (?:or|and) (?P<at>isc)
cc0 cc0
gpl-2 gplv?2
gpl-3 gplv?3
agpl-3 agplv?3
lgpl-2.1 lgplv?2\.1
lgpl-3 lgplv?3
bsd-2-clause bsd-2
bsd-3-clause bsd-3
wtfpl wtfpl
"""

FIELDS = r"""
mit licen[sc]e[\s"']*[:=][\s"'\[{]*mit
apache licen[sc]e[\s"']*[:=][\s"'\[{]*apache
apache-2 licen[sc]e[\s"']*[:=][\s"'\[{]*apache<2>
bsd licen[sc]e[\s"']*[:=][\s"'\[{]*bsd
bsd-2-clause licen[sc]e[\s"']*[:=][\s"'\[{]*bsd-2-clause
bsd-3-clause licen[sc]e[\s"']*[:=][\s"'\[{]*bsd-3-clause
gpl licen[sc]e[\s"']*[:=][\s"'\[{]*gpl
gpl-2 licen[sc]e[\s"']*[:=][\s"'\[{]*gpl<2>
gpl-3 licen[sc]e[\s"']*[:=][\s"'\[{]*gpl<3>
lgpl licen[sc]e[\s"']*[:=][\s"'\[{]*lgpl
lgpl-2.1 licen[sc]e[\s"']*[:=][\s"'\[{]*lgpl<2.1>
lgpl-3 licen[sc]e[\s"']*[:=][\s"'\[{]*lgpl<3>
agpl-3 licen[sc]e[\s"']*[:=][\s"'\[{]*agpl<3>
mpl-2.0 licen[sc]e[\s"']*[:=][\s"'\[{]*mpl<2>
isc licen[sc]e[\s"']*[:=][\s"'\[{]*isc
zlib licen[sc]e[\s"']*[:=][\s"'\[{]*zlib
unlicense licen[sc]e[\s"']*[:=][\s"'\[{]*unlicense
cc0 licen[sc]e[\s"']*[:=][\s"'\[{]*cc_?0
proprietary licen[sc]e[\s"']*[:=][\s"'\[{]*(?:proprietary|commercial|unlicensed)
all-rights-reserved all rights reserved
"""

WEAK = r"""
copyright copyright(?:\s*(?:\(c\)|©))?\s*(?:19|20)\d\d
copyright ©\s*(?:19|20)\d\d
"""

#: Kinds of signatures and how far one is trusted.
KINDS = ((0.99, SPDX), (0.97, NOTICES), (0.95, GRANTS), (0.9, NAMES), (0.8, SHORT), (0.7, FIELDS), (0.4, WEAK))


def _version(m: re.Match) -> str:
    v = m[1].replace(".", r"\.")
    return HEAD + v + (r"(?:\.0)?" if "." not in m[1] else "") + r"(?!\.?\d)"


def expand(pattern: str) -> str:
    """The regular expression that a line stands for."""
    for name, value in MACROS.items():
        pattern = pattern.replace(name, value)
    pattern = re.sub(r"<([\d.]+)>", _version, pattern).replace("_", r"[\s-]?").replace(" ", GAP)
    return (r"(?<!\w)" if re.match(r"[\w(]", pattern) else "") + pattern + r"(?!\w)"


def signatures() -> list[tuple[str, float, str]]:
    """(label, weight, regular expression), best kind first, as listed."""
    return [(label, weight, expand(pattern)) for weight, lines in KINDS
            for label, pattern in (line.split(" ", 1) for line in lines.strip().splitlines())]
